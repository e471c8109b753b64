"""Sequence conformance against a target path, with per-case explanations."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.columns import literal_map
from tracewright.log import ProcessLog
from tracewright.operators.discovery import trace_arrays

_OTHER = "."
# Long cases are compared piece by piece; costs of this many pieces fold per task.
PIECE_EVENTS = 50_000
FOLD_PIECES = 256


def path_code(ideal: Sequence[str]) -> tuple[str, dict[str, str]]:
    """The path as a string with one character per step, and the label dictionary.

    Only the labels of the path need a character: any other activity differs from every
    step in the same way, so all of them can share one.
    """
    alphabet = {label: chr(ord("A") + i) for i, label in enumerate(dict.fromkeys(ideal))}
    if len(alphabet) > 26:
        alphabet = {label: chr(0x4E00 + i) for i, label in enumerate(alphabet)}
    return "".join(alphabet[label] for label in ideal), alphabet


def activity_code(activity: Column, alphabet: dict[str, str]) -> Column:
    if not alphabet:
        return F.lit(_OTHER)
    return F.coalesce(F.try_element_at(literal_map(alphabet), activity), F.lit(_OTHER))


def edit_distance(steps: Column, ideal: Sequence[str]) -> Column:
    """Unit-cost token edit distance between an activity array and the path."""
    code, alphabet = path_code(ideal)
    observed = F.array_join(F.transform(steps, lambda a: activity_code(a, alphabet)), "")
    return F.levenshtein(observed, F.lit(code))


def fitness(distance: Column, length: Column, ideal: Sequence[str]) -> Column:
    longest = F.greatest(length, F.lit(len(ideal)), F.lit(1))
    return F.greatest(F.lit(0.0), F.lit(1.0) - distance / longest)


def _occurrences(steps: Column, activity: Column) -> Column:
    return F.size(F.filter(steps, lambda a: a == activity))


def _labels(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def deviations(steps: Column, ideal: Sequence[str]) -> dict[str, Column]:
    """Missing steps in path order; unexpected and repeated ones sorted by name."""
    need = Counter(ideal)
    once = [a for a, n in need.items() if n == 1]
    if len(once) == len(need):
        missing = F.array_except(_labels(once), steps)
    else:
        missing = F.filter(
            _labels(list(need)),
            lambda a: _occurrences(steps, a) < F.element_at(literal_map(dict(need)), a),
        )
    allowed = {a: n for a, n in need.items() if n > 1}

    def too_often(a):
        quota = F.lit(1)
        if allowed:
            quota = F.coalesce(F.try_element_at(literal_map(allowed), a), quota)
        return _occurrences(steps, a) > quota

    kinds = F.array_distinct(steps)
    repeated = F.when(
        F.size(kinds) < F.size(steps), F.array_sort(F.filter(kinds, too_often))
    ).otherwise(_labels([]))
    return {
        "missing": missing,
        "unexpected": F.array_sort(F.array_except(steps, _labels(list(need)))),
        "repeated": repeated,
    }


def conformance_arrays(log: ProcessLog, ideal: Sequence[str]) -> DataFrame:
    """Per case: fitness, distance, flag and the three deviation arrays.

    Scoring runs inside the task that gathered the trace, so the only shuffle is the one
    by case.
    """
    scored = trace_arrays(log).withColumn("edit_distance", edit_distance(F.col("steps"), ideal))
    found = deviations(F.col("steps"), ideal)
    out = scored.select(
        "case_id",
        fitness(F.col("edit_distance"), F.size("steps"), ideal).alias("fitness"),
        "edit_distance",
        (F.col("edit_distance") == 0).alias("conformant"),
        *[c.alias(name) for name, c in found.items()],
    )
    return out.unionByName(_long_conformance(log, ideal)) if log.has_long_cases else out


def _long_conformance(log: ProcessLog, ideal: Sequence[str]) -> DataFrame:
    """The same columns for long cases, from activity counts and piecewise distances."""
    counts = log.segments.groupBy("case_id", "activity").agg(F.count(F.lit(1)).alias("n"))
    # One row per case and activity, so the arrays below are bounded by the labels.
    tally = counts.groupBy("case_id").agg(
        F.sum("n").alias("length"),
        F.map_from_entries(F.collect_list(F.struct("activity", "n"))).alias("seen"),
    )
    need = Counter(ideal)
    quota = literal_map(dict(need))
    kinds = F.map_keys("seen")
    missing = F.filter(
        _labels(list(need)),
        lambda a: F.coalesce(F.try_element_at(F.col("seen"), a), F.lit(0))
        < F.element_at(quota, a),
    )
    repeated = F.filter(
        kinds,
        lambda a: F.element_at(F.col("seen"), a)
        > F.coalesce(F.try_element_at(quota, a), F.lit(1)),
    )
    return tally.join(_long_distance(log, ideal), "case_id").select(
        "case_id",
        fitness(F.col("edit_distance"), F.col("length"), ideal).alias("fitness"),
        "edit_distance",
        (F.col("edit_distance") == 0).alias("conformant"),
        missing.alias("missing"),
        F.array_sort(F.array_except(kinds, _labels(list(need)))).alias("unexpected"),
        F.array_sort(repeated).alias("repeated"),
    )


def _long_distance(
    log: ProcessLog, ideal: Sequence[str], piece: int | None = None, fold: int | None = None
) -> DataFrame:
    """Edit distance of long cases by splitting the trace instead of gathering it.

    An optimal alignment cuts the path wherever the trace is cut. A piece of the trace
    therefore contributes a table of costs, one per stretch ``ideal[i:j]`` of the path, and
    tables of neighbouring pieces combine by a min-plus product, which is associative: the
    pieces fold in a tree of bounded groups.
    """
    piece, fold = piece or PIECE_EVENTS, fold or FOLD_PIECES
    code, alphabet = path_code(ideal)
    size = len(code) + 1
    far = 1 << 40
    event = F.struct("position", activity_code(F.col("activity"), alphabet).alias("code"))
    pieces = log.segments.groupBy(
        "case_id", F.floor((F.col("position") - 1) / piece).alias("ord")
    ).agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(event)), lambda e: e["code"]), ""
        ).alias("text")
    )
    cells = [
        F.levenshtein("text", F.lit(code[i:j])).cast("bigint") if i <= j else F.lit(far)
        for i in range(size) for j in range(size)
    ]
    tables = pieces.select("case_id", "ord", F.array(*cells).alias("cost"))
    identity = F.array(*[
        F.lit(0 if i == j else far).cast("bigint") for i in range(size) for j in range(size)
    ])

    def product(a, b):
        def cell(p):
            row, column = F.floor(p / size).cast("int"), (p % size).cast("int")
            return F.array_min(F.transform(
                F.sequence(F.lit(0), F.lit(size - 1)),
                lambda k: F.get(a, row * size + k) + F.get(b, k * size + column),
            ))

        return F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), cell)

    count = -(-log.facts.longest_case // piece)
    while True:
        ordered = F.sort_array(F.collect_list(F.struct("ord", "cost")))
        tables = tables.groupBy("case_id", F.floor(F.col("ord") / fold).alias("ord")).agg(
            F.aggregate(ordered, identity, lambda acc, x: product(acc, x["cost"])).alias("cost")
        )
        if count <= fold:
            break
        count = -(-count // fold)
    # Start of the path to its end: first row, last column.
    return tables.select("case_id", F.get("cost", F.lit(size - 1)).alias("edit_distance"))


def conformance_cases(arrays: DataFrame) -> DataFrame:
    """Export form: deviation arrays joined to text."""
    return arrays.select(
        "case_id", "fitness", F.col("edit_distance").cast("int").alias("edit_distance"),
        "conformant",
        *[F.array_join(k, " | ").alias(f"{k}_activities")
          for k in ("missing", "unexpected", "repeated")],
    )


def deviation_summary(arrays: DataFrame) -> DataFrame:
    """Cases per deviation type and activity."""

    def tagged(kind):
        return F.transform(kind, lambda a: F.struct(
            F.lit(kind).alias("deviation_type"), a.alias("activity")
        ))

    found = F.concat(tagged("missing"), tagged("unexpected"), tagged("repeated"))
    return (
        arrays.select(F.inline(found))
        .groupBy("deviation_type", "activity").agg(F.count(F.lit(1)).alias("case_count"))
    )


def conformance_split(arrays: DataFrame) -> DataFrame:
    return arrays.agg(
        F.count_if("conformant").alias("conformant_cases"),
        F.count_if(~F.col("conformant")).alias("nonconformant_cases"),
    )


def fitness_histogram(arrays: DataFrame, bins: int = 10) -> DataFrame:
    """Cases per fitness band; a perfect score falls in the last band."""
    # The nudge keeps scores such as 0.3 (stored as 0.29999...) in the band they name.
    band = F.least(F.floor(F.col("fitness") * bins + F.lit(1e-9)), F.lit(bins - 1))
    return arrays.groupBy((band.cast("int") / bins).alias("fitness_from")).agg(
        F.count(F.lit(1)).alias("case_count")
    )


def reordered_cases(arrays: DataFrame) -> DataFrame:
    """Cases that deviate only in the order of their steps."""
    empty = [F.size(k) == 0 for k in ("missing", "unexpected", "repeated")]
    return arrays.where((F.col("edit_distance") > 0) & empty[0] & empty[1] & empty[2]).select(
        "case_id", "fitness", F.col("edit_distance").cast("int").alias("edit_distance")
    )


# Bits of a word that hold steps: two such words add up without overflow.
WORD_BITS = 62
_ALL = (1 << WORD_BITS) - 1


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _either(*words: Column) -> Column:
    out = words[0]
    for word in words[1:]:
        out = out.bitwiseOR(word)
    return out


def token_edit_distance(left: Column, right: Column) -> Column:
    """Edit distance between two array columns of any labels and lengths, bit-parallel.

    The steps of ``right`` are the bits of words, the matches of each label a word mask, and
    a column of the distance table two words of vertical differences, up and down. Each step of
    ``left`` advances all words by a few operations; what one word carries over goes into the next. So
    the work is ``len(left) * len(right) / 62`` word steps, and no label needs a code point.
    """
    one, zero, full = (F.lit(x).cast("bigint") for x in (1, 0, _ALL))
    empty = F.array().cast("array<bigint>")
    size = F.size(right)
    words = F.ceil(size / WORD_BITS).cast("int")
    numbers = F.sequence(F.lit(0), words - 1)
    high = F.call_function("shiftleft", one, F.lit(WORD_BITS - 1))
    # The last bit of the last word is the last row of the table: there the distance changes.
    last = F.call_function("shiftleft", one, (size - 1) % WORD_BITS)

    def mask(label, w):
        steps = F.slice(right, w * WORD_BITS + 1, F.lit(WORD_BITS))
        bits = F.transform(steps, lambda a, i: F.when(
            a.eqNullSafe(label), F.call_function("shiftleft", one, i)).otherwise(zero))
        return F.aggregate(bits, zero, lambda x, y: x.bitwiseOR(y))

    kinds = F.array_distinct(right)
    masks = F.transform(kinds, lambda a: F.transform(numbers, lambda w: mask(a, w)))
    nothing = F.transform(numbers, lambda w: zero)

    def flag(condition):
        return F.when(condition, one).otherwise(zero)

    def advance(state, w, own):
        """One word of one column; ``carry`` is the horizontal difference that comes in from below."""

        def carried(v):  # up, down, carry, own, top
            match = _either(v["own"], flag(v["carry"] < 0))
            spread = (match.bitwiseAND(v["up"]) + v["up"]).bitwiseAND(full).bitwiseXOR(
                v["up"]).bitwiseOR(match)
            return _bound(spread, lambda x: _bound(F.struct(
                _either(v["down"], full.bitwiseXOR(_either(x, v["up"]))).alias("plus"),
                v["up"].bitwiseAND(x).alias("minus")), lambda h: moved(v, h)))

        def moved(v, h):
            def shifted(x, sign):
                return F.call_function("shiftleft", x, F.lit(1)).bitwiseAND(full).bitwiseOR(
                    flag(v["carry"] * sign > 0))

            def out(x):
                return F.when(x.bitwiseAND(v["top"]) != 0, 1).otherwise(0)

            vertical = _either(v["own"], v["down"])
            return _bound(F.struct(
                shifted(h["plus"], 1).alias("plus"), shifted(h["minus"], -1).alias("minus"),
                vertical.alias("vertical"), (out(h["plus"]) - out(h["minus"])).alias("carry"),
            ), lambda x: F.struct(
                x["carry"].alias("carry"),
                F.concat(state["ups"], F.array(_either(x["minus"], full.bitwiseXOR(
                    _either(x["vertical"], x["plus"]))))).alias("ups"),
                F.concat(state["downs"], F.array(
                    x["plus"].bitwiseAND(x["vertical"]))).alias("downs")))

        return lambda up, down: _bound(F.struct(
            F.get(up, w).alias("up"), F.get(down, w).alias("down"), state["carry"].alias("carry"),
            own.alias("own"), F.when(w == words - 1, last).otherwise(high).alias("top")), carried)

    def column(state, label, masks):
        def stepped(found):
            start = F.struct(F.lit(1).alias("carry"), empty.alias("ups"), empty.alias("downs"))
            done = F.aggregate(numbers, start, lambda acc, w: advance(
                acc, w, F.get(found, w))(state["up"], state["down"]))
            return _bound(done, lambda d: F.struct(
                d["ups"].alias("up"), d["downs"].alias("down"),
                (state["score"] + d["carry"]).alias("score")))

        # A label that isn't there is at place 0, before the first.
        place = F.coalesce(F.array_position(kinds, label), F.lit(0)).cast("int")
        return _bound(F.coalesce(F.get(masks, place - 1), nothing), stepped)

    start = F.struct(
        F.transform(numbers, lambda w: full).alias("up"), nothing.alias("down"), size.alias("score"))
    distance = _bound(masks, lambda m: F.aggregate(
        left, start, lambda acc, label: column(acc, label, m), lambda acc: acc["score"]))
    return F.when(size == 0, F.size(left)).otherwise(distance)


def trace_distances(traces: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Each trace next to the one before it in its series: ``case_id, previous_case, edit_distance,
    fitness`` (the share of the longer trace that is kept).

    A pair is one row's work, so both traces have to fit one.
    """
    earlier = Window.partitionBy(*by).orderBy(*order)
    pairs = traces.select(
        "case_id", "steps", F.lag("case_id").over(earlier).alias("previous_case"),
        F.lag("steps").over(earlier).alias("before"),
    ).where(F.col("previous_case").isNotNull())
    longest = F.greatest(F.size("steps"), F.size("before"), F.lit(1))
    return pairs.withColumn("edit_distance", token_edit_distance(F.col("steps"), F.col("before"))).select(
        "case_id", "previous_case", "edit_distance",
        F.greatest(F.lit(0.0), 1 - F.col("edit_distance") / longest).alias("fitness"))
