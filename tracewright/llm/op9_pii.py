"""Personal data: high-recall candidates, boosted trees, calibrated thresholds. No Python UDFs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.session import durable

KINDS = ("email", "ip", "card", "phone")
#: Matches of the base, leftmost and not overlapping. Runs that cannot match are left at once
#: (a match starts a run or follows the last match), and loops keep what they took.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wider forms, whose spans the trees accept or refuse.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|[\[(](?:at|AT)[\])]) ?"
             r"[A-Za-z0-9-]{1,63}+(?: ?(?:\.|[\[(](?:dot|DOT)[\])]) ?[A-Za-z0-9-]{1,63}+){1,4}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}+(?![0-9.])",
    "card": r"(?<![0-9])[0-9]{4}+(?:[\x20.-]?[0-9]{4}+){2,3}+(?:[\x20.-]?[0-9]{1,3}+)?+(?![0-9])",
    "phone": r"(?<![0-9])(?:\+|00)?[0-9]{0,3}+[\x20.-]?[(]?[0-9]{3}[)]?[\x20.-][0-9]{3}"
             r"[\x20.-][0-9]{4}(?![0-9])",
}
#: A text without this cannot hold a match.
NEEDS = {"email": r"@|[\[(](?:at|AT)[\])]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20.-]?[0-9]",
         "phone": r"[0-9][\x20().0-9-]"}
CUES = {"email": "mail|contact|write", "ip": "ip|host|server|addr", "card": "card|visa|credit|pay",
        "phone": "phone|tel|call|mobile|fax"}
FEATURES = ("kind_no", "length", "digits", "groups", "dots", "dashes", "spaces", "brackets", "plus",
            "luhn", "octets", "distinct_digits", "cue", "quoted", "glued", "digit_near", "token_near")
CONTEXT = 24


def _matches(text: Column, kind: str, form: str, pattern: str) -> Column:
    """Matches in order, each with the text between it and the one before, and around it."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    listed = F.transform(found, lambda m, i: F.struct(
        F.lit(kind).alias("kind"), F.lit(form).alias("form"), i.alias("number"),
        F.length(F.get(gaps, i)).alias("gap"), m.alias("match"),
        F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"),
        F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("after")))
    return F.when(F.rlike(text, F.lit(NEEDS[kind])), listed).otherwise(
        F.array().cast("array<struct<kind:string,form:string,number:int,gap:int,match:string,"
                       "before:string,after:string>>"))


def _luhn(digits: Column) -> Column:
    """Whether the digits pass Luhn's check."""
    reverse = F.split(F.reverse(digits), "")
    total = F.aggregate(F.transform(reverse, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int"))),
        F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return (F.length(digits) > 0) & (total % 10 == 0)


def candidates(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Every match of the base and the wide forms: ``doc, txt, kind, form, start, stop, match``,
    the text around it, and ``valid``, whether it passes the base's own check.

    Offsets are code points. Documents are told apart by id and text.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    listed = F.concat(*(_matches(body, kind, form, patterns[kind])
                        for form, patterns in (("base", BASE), ("wide", WIDE)) for kind in KINDS))
    rows = documents.select(
        F.col(doc_id).alias("doc"), F.xxhash64(body).alias("txt"), F.inline(listed)).dropDuplicates(
        ["doc", "txt", "kind", "form", "number"])
    passed = Window.partitionBy("doc", "txt", "kind", "form").orderBy("number")
    rows = rows.withColumn("stop", F.sum(F.col("gap") + F.length("match")).over(passed)).withColumn(
        "start", F.col("stop") - F.length("match"))
    digits = F.regexp_replace("match", "[^0-9]", "")
    octets = F.forall(F.split("match", r"\."), lambda x: (
        F.length(F.ltrim(x, F.lit("0"))) <= 3) & (F.coalesce(
            F.ltrim(x, F.lit("0")).try_cast("int"), F.lit(0)) <= 255))
    size = F.length(digits)
    valid = (
        F.when(F.col("kind") == "email", F.lit(True))
        .when(F.col("kind") == "ip", octets)
        .when(F.col("kind") == "card", size.between(12, 19) & _luhn(digits))
        .otherwise(size.between(9, 15)))
    return rows.withColumn("valid", valid & (F.col("form") == "base"))


def features(rows: DataFrame) -> DataFrame:
    """Format and context of each candidate, as numbers."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    number = F.expr(" ".join(["CASE kind", *(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)),
                              "END"]))
    cue = F.lit(False)
    for kind, pattern in CUES.items():
        cue = cue | ((F.col("kind") == kind) & F.rlike(F.lower("before"), F.lit(pattern)))
    count = {
        "kind_no": number, "length": F.length("match"), "digits": F.length(digits),
        "groups": F.regexp_count("match", F.lit("[0-9]+")),
        "dots": F.regexp_count("match", F.lit(r"\.")), "dashes": F.regexp_count("match", F.lit("-")),
        "spaces": F.regexp_count("match", F.lit(" ")),
        "brackets": F.regexp_count("match", F.lit(r"[()\[\]]")),
        "plus": F.startswith("match", F.lit("+")), "luhn": _luhn(digits),
        "octets": F.regexp_count("match", F.lit(r"(?<![0-9])(?:[01]?[0-9]?[0-9]|2[0-4][0-9]|25[0-5])"
                                                r"(?![0-9])")),
        "distinct_digits": F.size(F.array_distinct(F.split(digits, ""))), "cue": cue,
        "quoted": F.rlike("before", F.lit(r"[\"']$")) & F.rlike("after", F.lit(r"^[\"']")),
        "glued": F.rlike("before", F.lit(r"\w$")) | F.rlike("after", F.lit(r"^\w")),
        "digit_near": F.rlike("before", F.lit("[0-9]")) | F.rlike("after", F.lit("[0-9]")),
        "token_near": F.rlike("before", F.lit("[0-9a-f]$")) | F.rlike("after", F.lit("^[0-9a-f]")),
    }
    return rows.withColumns({k: v.cast("double") for k, v in count.items()})


def _fits(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="_vector",
                           handleInvalid="keep").transform(rows)


@dataclass
class PiiModel:
    trees: GBTClassificationModel | None
    thresholds: dict[str, float]


def fit(found: DataFrame, rounds: int = 8, depth: int = 4, precision: float = 0.98) -> PiiModel:
    """Boosted trees that tell checked base matches from matches that fail the check.

    Learns from all base candidates but a quarter, held out by a hash of document and place; each
    kind's threshold is the least score from which on ``precision`` of the held out are real.
    Candidates with the same features are one row with their number as its weight, so the trees
    see every one of them, and passes cost what tells candidates apart. A kind without such a
    score adds nothing, and neither does a model without both sorts of candidates.
    """
    mark = F.xxhash64("doc", "txt", "kind", "start", "stop")
    rows = durable(
        features(found.where("form = 'base'"))
        .withColumn("label", F.col("valid").cast("double"))
        .withColumn("_held", F.pmod(mark, F.lit(4)) == 0)
        .groupBy("kind", "label", "_held", *FEATURES).agg(F.count("*").cast("double").alias("n")))
    learn = rows.where("not _held")
    if learn.select("label").distinct().count() < 2:
        return PiiModel(None, {})
    trees = GBTClassifier(featuresCol="_vector", labelCol="label", weightCol="n", maxIter=rounds,
                          maxDepth=depth, seed=5, checkpointInterval=-1).fit(_fits(learn))
    scored = trees.transform(_fits(rows.where("_held"))).select(
        "kind", "label", "n", F.round(vector_to_array("probability")[1], 2).alias("score"))
    by_score = Window.partitionBy("kind").orderBy(F.desc("score"))
    cuts = (  # at most 101 scores of each kind
        scored.groupBy("kind", "score").agg(
            F.sum(F.col("label") * F.col("n")).alias("real"), F.sum("n").alias("n"))
        .withColumn("share", F.sum("real").over(by_score) / F.sum("n").over(by_score))
        .where((F.col("share") >= precision) & (F.col("score") >= 0.5))
        .groupBy("kind").agg(F.min("score").alias("cut")))
    return PiiModel(trees, {r.kind: r.cut for r in cuts.collect()})


def spans(found: DataFrame, model: PiiModel) -> DataFrame:
    """Base matches that pass their check, and the wide candidates whose score reaches their
    kind's threshold and that are not inside a base span: ``doc, txt, kind, start, stop, base``."""
    columns = ["doc", "txt", "kind", "start", "stop"]
    base = found.where("valid").select(*columns, F.lit(True).alias("base"))
    if model.trees is None or not model.thresholds:
        return base
    cut = F.create_map(*(x for k, v in model.thresholds.items() for x in (F.lit(k), F.lit(v))))
    scored = model.trees.transform(_fits(features(found.where("form = 'wide'"))))
    wide = scored.where(F.round(vector_to_array("probability")[1], 2) >= cut[F.col("kind")]).select(
        *columns)
    # A document's spans by start; the furthest end of base spans that start no later.
    both = base.unionByName(wide.withColumn("base", F.lit(False)))
    reach = F.max(F.when(F.col("base"), F.col("stop"))).over(
        Window.partitionBy("doc", "txt").orderBy("start").rangeBetween(
            Window.unboundedPreceding, Window.currentRow))
    return both.withColumn("_reach", reach).where(
        "base or _reach is null or stop > _reach").drop("_reach").dropDuplicates([*columns, "base"])


def find_pii(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
             model: PiiModel | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base``
    and ``spans``: arrays of ``(start, kind_no, kind, stop)`` in order, of the base's matches and of
    all. Null and empty texts have none; repeated rows get the same result; null ids are ids.

    Texts without digits or ``@`` are left after a look; only candidates are shuffled. A document
    with very many matches is one group of small rows.
    """
    found = durable(candidates(documents, doc_id, text))
    model = fit(found) if model is None else model
    number = F.expr(" ".join(["CASE kind", *(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)),
                              "END"]))
    one = F.struct("start", number.alias("kind_no"), "kind", "stop")
    grouped = spans(found, model).groupBy("doc", "txt").agg(
        F.array_sort(F.collect_list(F.when(F.col("base"), one))).alias("base"),
        F.array_sort(F.collect_set(one)).alias("spans"),
        *(F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS))
    grouped = grouped.withColumnsRenamed({"doc": "_d", "txt": "_t"})
    rows = documents.select(F.col(doc_id).alias("doc"),
                            F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("txt"))
    none = F.array().cast("array<struct<start:bigint,kind_no:int,kind:string,stop:bigint>>")
    return rows.join(
        grouped, F.col("doc").eqNullSafe(F.col("_d")) & (F.col("txt") == F.col("_t")), "left").select(
        F.col("doc").alias(doc_id), F.col("txt"),
        *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS),
        F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def _listed(column: str) -> Column:
    return F.array_join(F.transform(column, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digest(result: DataFrame) -> DataFrame:
    return result.withColumn("base_sha256", F.sha2(_listed("base").cast("binary"), 256)).withColumn(
        "spans", _listed("spans")).drop("base", "txt")


def redact(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]`` in place of each span;
    of overlapping ones the earliest stays whole, and what reaches beyond it goes too."""
    found = find_pii(documents, doc_id, text).where(F.size("spans") > 0).select(
        F.col(doc_id).alias("_d"), F.col("txt").alias("_t"), "spans").dropDuplicates(["_d", "_t"])
    body = F.col(text)
    built = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["stop"]).alias("at"),
            F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.array(
                F.substring(body, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))).alias("out")),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(
            body, (a["at"] + 1).cast("int"), F.length(body))))
    joined = documents.withColumn("_x", F.xxhash64(F.coalesce(F.col(text), F.lit("")))).join(
        found, F.col(doc_id).eqNullSafe(F.col("_d")) & (F.col("_x") == F.col("_t")), "left")
    return joined.withColumn(text, F.when(F.col("spans").isNull(), body).otherwise(built)).select(
        *documents.columns)
