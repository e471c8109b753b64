"""Which sources of a language write differently: an audit of term shares, exact to the unit.

Identical texts of a language are collapsed with their copies per source, so each is cut into terms once.
Counts are added up through an exchange of packed arrays, term ranges getting narrower as blocks
of text are joined, so that a row of it stays large at any input size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.words import mix
from tracewright.session import broadcast_if_small, durable

FAN = 128  # blocks that one merge takes in, and ranges of terms it deals them to
SCALE = 1_000_000_000

_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[128:] = True
_INSIDE[65:91] = _INSIDE[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = np.random.default_rng(90_125).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) \
    + np.uint64(1)
_STEP = np.uint64(0xD6E8FEB86659FD95)

PACKED = ("block long, part long, langs array<string>, sources array<string>, terms binary, "
          "term binary, owner binary, counts binary, docs binary")


# ---- terms and counts as arrays ----------------------------------------------------------------


def find_terms(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Runs of letters A-Z and of characters beyond ASCII, lower-cased, and the text of each."""
    buffer = _LOWER[np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)]
    inside = _INSIDE[buffer]
    turns = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    starts, ends = turns[::2], turns[1::2]
    limits = np.cumsum([len(x) + 1 for x in texts], dtype=np.int64)
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(offsets), pa.py_buffer(buffer[inside])])
    return found.dictionary_encode(), np.searchsorted(limits, starts, side="right")


def summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys, ascending, and the sum of each one's values."""
    if not len(key):
        return key, *values
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
    return key[first], *(np.add.reduceat(x[order], first) for x in values)


def _small(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs; the first byte says how many."""
    width = next(w for w in (1, 2, 4, 8) if int(values.max(initial=0)) < 1 << (8 * w - 1))
    return bytes([width]) + values.astype(f"<i{width}").tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<i{raw[0]}", offset=1).astype(np.int64)


def _slices(texts: list[bytes], size: int = 4 << 20) -> Iterator[tuple[list[bytes], list[int]]]:
    """Texts in slices of about ``size`` bytes, with their numbers; a longer one is cut at a space."""
    held, numbers, total = [], [], 0
    for number, text in enumerate(texts):
        at = 0
        while at < len(text):
            to = len(text)
            if to - at > size:
                to = text.find(b" ", at + size)
                to = len(text) if to < 0 else to
            held.append(text[at:to])
            numbers.append(number)
            total += to - at
            at = to
            if total >= size:
                yield held, numbers
                held, numbers, total = [], [], 0
    if held:
        yield held, numbers


class Counts:
    """Occurrences and documents of terms by (lang, source)."""

    def __init__(self, groups: list[tuple[str, str]], terms: pa.Array, owner, term, counts, docs):
        self.groups, self.terms = groups, terms
        key, self.counts, self.docs = summed(owner * max(1, len(terms)) + term, counts, docs)
        self.owner, self.term = np.divmod(key, max(1, len(terms)))

    @staticmethod
    def of_texts(rows: dict[tuple[str, str], dict[str, int]]) -> Counts:
        """Of distinct (lang, text) pairs with the copies that each source has."""
        keys = list(rows)
        texts = [text.encode() for _, text in keys]
        dictionaries, text_parts, term_parts = [], [], []
        base = 0
        for held, numbers in _slices(texts):
            found, text = find_terms(held)
            dictionaries.append(found.dictionary)
            text_parts.append(np.array(numbers, dtype=np.int64)[text])
            term_parts.append(found.indices.to_numpy(zero_copy_only=False).astype(np.int64) + base)
            base += len(found.dictionary)
        joined = (pa.concat_arrays(dictionaries) if dictionaries
                  else pa.array([], pa.large_binary())).dictionary_encode()
        terms = joined.dictionary
        text = np.concatenate(text_parts) if text_parts else np.zeros(0, np.int64)
        term = np.concatenate(term_parts) if term_parts else np.zeros(0, np.int64)
        term = joined.indices.to_numpy(zero_copy_only=False).astype(np.int64)[term]
        each, times = summed(text * max(1, len(terms)) + term, np.ones(len(text), dtype=np.int64))
        text, term = np.divmod(each, max(1, len(terms)))
        # Each text's counts go to every source that has it, as often as it has it.
        groups: dict[tuple[str, str], int] = {}
        owners, copies, many = [], [], []
        for lang, body in keys:
            own = rows[lang, body]
            many.append(len(own))
            for source, n in own.items():
                owners.append(groups.setdefault((lang, source), len(groups)))
                copies.append(n)
        many = np.array(many, dtype=np.int64)
        first = np.cumsum(many) - many
        repeat = many[text]
        pick = np.repeat(np.arange(len(text)), repeat)
        within = np.arange(len(pick)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        at = first[text[pick]] + within
        owners, copies = (np.array(x, dtype=np.int64) for x in (owners, copies))
        return Counts(list(groups), terms, owners[at], term[pick], times[pick] * copies[at], copies[at])

    @staticmethod
    def merged(table: pa.Table) -> Counts:
        """The sum of packed counts."""
        groups: dict[tuple[str, str], int] = {}
        dictionaries, parts, base = [], [], 0
        for langs, sources, terms, *rest in zip(*(table[x].to_pylist() for x in (
                "langs", "sources", "terms", "term", "owner", "counts", "docs")), strict=True):
            own = pa.array(terms.split(b" ") if terms else [], pa.large_binary())
            dictionaries.append(own)
            place = np.array([groups.setdefault(g, len(groups)) for g in
                              zip(langs, sources, strict=True)], dtype=np.int64)
            term, owner, counts, docs = map(_wide, rest)
            parts.append((place[owner], term + base, counts, docs))
            base += len(own)
        joined = pa.concat_arrays(dictionaries).dictionary_encode()
        owner, term, counts, docs = (np.concatenate(x) for x in zip(*parts, strict=True))
        number = joined.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        return Counts(list(groups), joined.dictionary, owner, number[term], counts, docs)

    def hashes(self) -> np.ndarray:
        """64 bits of each term."""
        if not len(self.terms):
            return np.zeros(0, dtype=np.uint64)
        offsets = np.frombuffer(self.terms.buffers()[1], dtype=np.int64)[
            self.terms.offset:self.terms.offset + len(self.terms) + 1]
        data = np.frombuffer(self.terms.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
        lengths = np.diff(offsets)
        powers = np.full(int(lengths.max()), _STEP, dtype=np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        within = np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], lengths)
        return mix(np.add.reduceat(_VALUES[data] * powers[within], offsets[:-1] - offsets[0]))

    def packed(self, block: int, part: int, level: int, fan: int) -> pa.Table:
        """Rows that carry the counts on, one for each of ``fan`` narrower ranges of terms."""
        digit = ((self.hashes() >> np.uint64(8 * level)) % np.uint64(fan)).astype(np.int64)
        order = np.argsort(digit[self.term], kind="stable")
        owner, term, counts, docs = (x[order] for x in (self.owner, self.term, self.counts, self.docs))
        cuts = np.searchsorted(digit[term], np.arange(fan + 1))
        out = []
        for d in range(fan):
            a, b = cuts[d], cuts[d + 1]
            if a == b:
                continue
            terms, number = np.unique(term[a:b], return_inverse=True)
            groups, place = np.unique(owner[a:b], return_inverse=True)
            out.append({
                "block": block, "part": part * fan + d,
                "langs": [self.groups[g][0] for g in groups.tolist()],
                "sources": [self.groups[g][1] for g in groups.tolist()],
                "terms": b" ".join(self.terms.take(pa.array(terms)).to_pylist()),
                "term": _small(number), "owner": _small(place),
                "counts": _small(counts[a:b]), "docs": _small(docs[a:b])})
        text, raw = pa.list_(pa.string()), pa.binary()
        return pa.Table.from_pylist(out, schema=pa.schema([
            ("block", pa.int64()), ("part", pa.int64()), ("langs", text), ("sources", text),
            ("terms", raw), ("term", raw), ("owner", raw), ("counts", raw), ("docs", raw)]))

    def kept(self, least: int) -> pa.Table:
        """Rows of the terms that at least ``least`` documents of their language have."""
        langs = {lang: i for i, lang in enumerate(dict.fromkeys(x for x, _ in self.groups))}
        lang = np.array([langs[x] for x, _ in self.groups], dtype=np.int64)[self.owner]
        both = lang * max(1, len(self.terms)) + self.term
        key, total, docs = summed(both, self.counts, self.docs)
        at = np.searchsorted(key, both)
        stays = np.flatnonzero(docs[at] >= least) if len(both) else both
        lead = np.zeros(len(stays), dtype=bool)
        lead[np.unique(both[stays], return_index=True)[1]] = True
        owner = self.owner[stays]
        of = [pa.array([x[i] for x in self.groups], pa.string()).take(pa.array(owner)) for i in (0, 1)]
        return pa.table({
            "lang": of[0], "source": of[1],
            "term": self.terms.take(pa.array(self.term[stays])).cast(pa.large_string()).cast(pa.string()),
            "n": pa.array(self.counts[stays]), "total": pa.array(total[at[stays]]),
            "lead": pa.array(lead)})


# ---- all documents ------------------------------------------------------------------------------


def collapsed(documents: DataFrame, hold_bytes: int = 16 << 20) -> DataFrame:
    """(lang, text) with the copies of each source, added up inside every task before the texts
    travel; a text that a third of all rows hold is sent once for each ``hold_bytes`` of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[str, int]] = {}
        size = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([x for x, _ in held], pa.string()), pa.array([x for _, x in held], pa.string()),
                pa.array([list(x) for x in held.values()], pa.list_(pa.string())),
                pa.array([list(x.values()) for x in held.values()], pa.list_(pa.int64())),
            ], names=["lang", "text", "sources", "copies"])

        for batch in batches:
            for lang, text, source in zip(*(batch[x].to_pylist() for x in ("lang", "text", "source")),
                                          strict=True):
                own = held.setdefault((lang, text), {})
                size += 0 if own else len(text)
                own[source] = own.get(source, 0) + 1
                if size >= hold_bytes:
                    yield out()
                    held.clear()
                    size = 0
        if held:
            yield out()

    return documents.where("text != ''").mapInArrow(
        run, "lang string, text string, sources array<string>, copies array<long>")


def term_counts(documents: DataFrame, blocks: int, least: int) -> DataFrame:
    """``lang, source, term, n, total, lead`` of the kept terms that a source has; ``total`` is the
    language's count, and ``lead`` marks one row of each of its terms. ``documents``: lang, source and text without nulls."""

    def count(table: pa.Table) -> pa.Table:
        rows: dict[tuple[str, str], dict[str, int]] = {}
        for lang, text, sources, copies in zip(*(table[x].to_pylist() for x in (
                "lang", "text", "sources", "copies")), strict=True):
            own = rows.setdefault((lang, text), {})
            for source, n in zip(sources, copies, strict=True):
                own[source] = own.get(source, 0) + n
        return Counts.of_texts(rows).packed(table["block"][0].as_py(), 0, 0, min(FAN, blocks))

    def joined(level: int, fan: int):
        def run(table: pa.Table) -> pa.Table:
            counts = Counts.merged(table)
            if not fan:
                return counts.kept(least)
            return counts.packed(table["block"][0].as_py(), table["part"][0].as_py(), level, fan)
        return run

    packed = collapsed(documents).withColumn(
        "block", F.pmod(F.xxhash64("lang", "text"), F.lit(blocks))).groupBy("block").applyInArrow(
        count, PACKED)
    level = 0
    while True:
        packed = packed.withColumn("block", F.floor(F.col("block") / FAN))
        blocks, level = -(-blocks // FAN), level + 1
        groups = packed.groupBy("block", "part")
        if blocks <= 1:
            return groups.applyInArrow(
                joined(level, 0), "lang string, source string, term string, n long, total long, lead boolean")
        packed = groups.applyInArrow(joined(level, min(FAN, blocks)), PACKED)


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exact; 0 where no term is kept."""
    wide = lambda x: x.cast("decimal(19,0)")
    return F.when(kept == 0, 0).otherwise(1 + F.call_function(
        "div", F.lit(SCALE).cast("decimal(10,0)") * (wide(count) + 2), wide(total) + 2 * wide(kept)))


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); 0 for two zeros."""
    return F.when(p + q > 0, F.call_function("div", (p - q) * (p - q), p + q)).otherwise(0)


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _shared_terms(table: pa.Table) -> pa.Table:
    """For two sources of a language, what the terms that both have change against the sum in which
    each source's terms meet the other's zero; added up over all terms of the group."""
    codes = [table[x].combine_chunks().dictionary_encode() for x in ("lang", "source", "term")]
    lang, source, term = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in codes)
    names = codes[1].dictionary.to_pylist()
    rank = np.empty(len(names), dtype=np.int64)
    rank[sorted(range(len(names)), key=lambda i: names[i].encode())] = np.arange(len(names))
    order = np.lexsort((rank[source], term, lang))
    lang, source, term = lang[order], source[order], term[order]
    p, zero = (table[x].to_numpy()[order] for x in ("p", "zero"))
    keys, values, size = [], [], 0
    for step in range(1, len(p)):
        a = np.flatnonzero((term[step:] == term[:-step]) & (lang[step:] == lang[:-step]))
        if not len(a):
            break
        b = a + step
        keys.append((lang[a] * len(names) + source[a]) * len(names) + source[b])
        values.append(_gaps(p[a], p[b]) - _gaps(p[a], zero[b]) - _gaps(zero[a], p[b])
                      + _gaps(zero[a], zero[b]))
        size += len(a)
        if size > 4_000_000:
            keys, values = ([x] for x in summed(np.concatenate(keys), np.concatenate(values)))
            size = len(keys[0])
    key, value = summed(*(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, values)))
    first, b = np.divmod(key, max(1, len(names)))
    of, a = np.divmod(first, max(1, len(names)))
    take = lambda d, i: d.take(pa.array(i))
    return pa.table({"lang": take(codes[0].dictionary, of), "a": take(codes[1].dictionary, a),
                     "b": take(codes[1].dictionary, b), "value": pa.array(value)})


def audit(
    documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    least: int = 10, top: int = 10, block_bytes: int = 8 << 20,
) -> DataFrame:
    """How far the sources of each language are from each other, and the terms that set them apart.

    ``lang, source, part, item, value, rank``. Part ``pair``: every other source of the language by
    the sum of ``gap`` over the kept terms (those in at least ``least`` documents of the language).
    Part ``term``: the ``top`` kept terms that the source has and uses more than its language. Values
    descend, ties go to the smaller item in UTF-8. Null texts, langs and sources are empty ones; repeated rows
    are documents each. A group without terms has pairs; where no term is kept their value is 0.
    An empty table gives no rows; further columns are ignored. Texts are whole at any length.

    Pairs are evaluated from what is there: the sum in which each source's terms meet zeros comes from
    how often each count occurs in a source, terms that both have are corrected one by one, and the
    terms of neither are one product. The pairs of a language are the result itself.
    """
    whole = documents.select(*(F.coalesce(F.col(a).cast("string"), F.lit("")).alias(b) for a, b in (
        (lang, "lang"), (source, "source"), (text, "text"))))
    found = durable(whole.groupBy("lang", "source").agg(
        F.sum(F.octet_length("text").cast("long")).alias("bytes")))
    size, number = found.agg(F.sum("bytes"), F.count("*")).first()
    blocks = max(1, -(-(size or 0) // block_bytes))
    rows = durable(term_counts(whole, blocks, least))
    sums = rows.groupBy("lang", "source").agg(
        F.sum("n").alias("sum"), F.count("*").alias("terms"), F.count_if("lead").alias("leads"))
    whole_lang = Window.partitionBy("lang")
    groups = found.join(sums, ["lang", "source"], "left").select("lang", "source", *(
        F.coalesce(x, F.lit(0)).alias(x) for x in ("sum", "terms", "leads"))).withColumns({
            "kept": F.sum("leads").over(whole_lang), "all": F.sum("sum").over(whole_lang)})
    groups = durable(groups.withColumn("zero", share(F.lit(0), F.col("sum"), F.col("kept"))))

    entries = rows.join(broadcast_if_small(groups, number), ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("sum"), F.col("kept")).alias("p"),
        share(F.col("total"), F.col("all"), F.col("kept")).alias("q"), "zero")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = entries.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    other = groups.select("lang", F.col("source").alias("t"), F.col("zero").alias("q"))
    zeros = groups.select("lang", F.col("zero").alias("q")).distinct()
    against = (  # each source's terms against every zero that its language has
        entries.groupBy("lang", "source", "p").agg(F.count("*").alias("n"))
        .join(broadcast_if_small(zeros, number), "lang")
        .groupBy("lang", "source", "q").agg(F.sum(F.col("n") * gap(F.col("p"), F.col("q"))).alias("value"))
        .join(broadcast_if_small(other, number), ["lang", "q"]).where("source != t"))
    first, last = F.least("source", "t"), F.greatest("source", "t")
    against = against.select("lang", first.alias("a"), last.alias("b"), "value")
    parts = max(1, blocks)
    both = entries.withColumn("part", F.pmod(F.xxhash64("lang", "term"), F.lit(parts))).groupBy(
        "part").applyInArrow(_shared_terms, "lang string, a string, b string, value long")
    left, right = groups.alias("x"), groups.alias("y")
    neither = left.join(broadcast_if_small(right, number), F.expr(
        "x.lang = y.lang AND x.source < y.source")).select(
        F.col("x.lang").alias("lang"), F.col("x.source").alias("a"), F.col("y.source").alias("b"),
        (F.expr("x.kept - x.terms - y.terms") * gap(F.col("x.zero"), F.col("y.zero"))).alias("value"))
    pairs = neither.unionByName(against).unionByName(both).groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value"))
    pairs = pairs.select("lang", "value", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("s")).select(
        "lang", "s.source", "s.item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        terms.withColumn("part", F.lit("term")).select(*columns))
