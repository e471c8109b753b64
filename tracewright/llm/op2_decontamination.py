"""Benchmark decontamination by winnowing, in DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.session import durable

#: ASCII but digits and small letters separates words, after A-Z are folded.
OUTSIDE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of fingerprints or windows up to which the benchmark's side is broadcast.
BROADCAST_ROWS = 300_000


def words_of(text: Column) -> Column:
    """Words of a text, A-Z folded and nothing else; plain ASCII takes the fast way."""
    text = F.coalesce(text, F.lit(""))
    folded = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(folded, OUTSIDE), "")


def _upto(n: Column) -> Column:
    """1, 2, ..., n, or nothing."""
    return F.when(n >= 1, F.sequence(F.lit(1), n.cast("int"))).otherwise(
        F.array().cast("array<int>"))


def _run(values: str, first: Column, last: Column) -> Column:
    """Values number ``first`` to ``last``. ``slice`` reads the whole array each time."""
    return F.transform(F.sequence(first, last), lambda i: F.get(values, i - 1))


def fingerprints(rows: DataFrame, window: int, gram: int, short: list[int]) -> DataFrame:
    """``rows`` with the array ``prints`` of ``(print, start, size, context)``.

    Every window of ``window`` words has the least hash of its ``gram``-word runs; neighbours
    with the same least one share an entry, whose context holds their words. Equal windows have
    equal entries, so none is missed. For each size in ``short`` every run of it is an entry.
    """
    wide = window - gram + 1
    rows = rows.withColumn("_hashed", F.transform("words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("_grams", F.transform(
        F.when(F.size("_hashed") >= window, _upto(F.size("_hashed") - gram + 1)).otherwise(
            F.array().cast("array<int>")),
        lambda i: F.xxhash64(*(F.get("_hashed", i + k - 1) for k in range(gram)))))
    rows = rows.withColumn("_least", F.transform(
        _upto(F.size("_grams") - wide + 1),
        lambda i: F.least(*(F.get("_grams", i + k - 1) for k in range(wide)))))
    rows = rows.withColumn("_begins", F.filter(
        _upto(F.size("_least")),
        lambda i: (i == 1) | (F.get("_least", i - 1) != F.get("_least", i - 2))))
    prints = F.transform("_begins", lambda at, i: F.struct(
        F.get("_least", at - 1).alias("print"), at.alias("start"), F.lit(window).alias("size"),
        _run("words", at, F.coalesce(F.get("_begins", i + 1), F.size("_least") + 1) + window - 2)
        .alias("context")))
    for size in short:  # each lambda is read at once
        prints = F.concat(prints, F.transform(
            _upto(F.size("words") - size + 1), lambda i: F.struct(
                F.xxhash64(F.lit(size), *(F.get("_hashed", i + k - 1) for k in range(size)))
                .alias("print"),
                i.alias("start"), F.lit(size).alias("size"),
                _run("words", i, i + size - 1).alias("context"))))
    return rows.withColumn("prints", prints).drop("_hashed", "_grams", "_least", "_begins")


def _windows(rows: DataFrame, *columns: str) -> DataFrame:
    """Every window of the entries' contexts: its words as one text, and where it starts."""
    own = F.transform(
        _upto(F.size("entry.context") - F.col("entry.size") + 1),
        lambda j: F.struct(
            (F.col("entry.start") + j - 1).alias("start"), F.col("entry.size").alias("size"),
            F.array_join(_run("entry.context", j, j + F.col("entry.size") - 1), " ")
            .alias("window")))
    return rows.select(*columns, F.inline_outer(own))


def _checked(side: DataFrame, most: int) -> DataFrame:
    """Broadcast if it has at most ``most`` rows; else the join is left to Spark."""
    return F.broadcast(side) if side.limit(most + 1).count() <= most else side


def _met(documents: DataFrame, prints: DataFrame, window: int, gram: int, short: list[int]) -> DataFrame:
    """``doc, txt, entry`` of the entries whose print is in ``prints``, and of one more per document:
    its size is 0 and its start the document's number of words. So texts are cut into words once.
    """
    spread = fingerprints(documents, window, gram, short)
    # Any print will do; that of the row spreads them where the join is a shuffle.
    own = F.struct(
        F.xxhash64("doc", "txt").alias("print"), F.size("words").alias("start"),
        F.lit(0).alias("size"), F.array().cast("array<string>").alias("context"))
    # Outer: an inferred filter on the array would compute it a second time, all in one.
    entries = spread.select("doc", "txt", F.explode_outer(F.concat(F.array(own), "prints")).alias("entry"))
    return entries.withColumn("print", F.col("entry.print")).join(prints, "print", "left").where(
        F.col("known") | (F.col("entry.size") == 0)).select("doc", "txt", "entry")


def contaminated(documents: DataFrame, benchmark: DataFrame, *columns, **options) -> DataFrame:
    """``contaminated_rows`` without the hash of the text."""
    return contaminated_rows(documents, benchmark, *columns, **options).drop("txt")


def contaminated_rows(
    documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = 10, gram: int = 5,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per document: ``doc_id, txt, n_words, n_hit, n_items, items, contaminated``;
    ``txt`` is the 64-bit hash of its text.

    A window is ``window`` consecutive words of an item, or all of a shorter one that has words.
    ``n_hit`` counts document words inside any occurrence of a window, ``items`` lists the ids,
    as sorted strings, of the items whose windows occur. Documents' fingerprints meet the
    benchmark's; entries that meet are written down, with the number of each document's words, and
    extended to their windows, which are compared as text.

    Nulls have no words; a null item id is an empty string, and equal ids are one item. Documents
    are told apart by id and text, so repeated rows get the same result. No Python, and no task
    sees more than a document; the benchmark's side is broadcast only below ``broadcast_rows``.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
        words_of(F.col(item_text)).alias("words")).where(F.size("words") > 0)
    short = sorted(r[0] for r in items.where(F.size("words") < window).select(
        F.size("words")).distinct().collect())  # fewer than ``window`` values
    sized = F.col("entry.size") == F.least(F.size("words"), F.lit(window))
    entries = fingerprints(items, window, gram, short).select(
        "item", "words", F.explode_outer("prints").alias("entry")).where(sized)
    prints = entries.select(F.col("entry.print").alias("print")).distinct()
    of_items = _windows(entries, "item").select("item", "window", "size").distinct()

    read = documents.select(
        F.col(doc_id).alias("doc"), F.xxhash64(text).alias("txt"), words_of(F.col(text)).alias("words"))
    met = durable(_met(
        read, _checked(prints.withColumn("known", F.lit(True)), broadcast_rows), window, gram, short))
    hits = _windows(met.where("entry.size > 0"), "doc", "txt").join(
        _checked(of_items, broadcast_rows), ["window", "size"])
    found = hits.groupBy("doc", "txt").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("stop"))))
        .alias("spans"),
        F.array_sort(F.collect_set("item")).alias("items"))
    # Words in the union of the spans, which come by start.
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("stop"), F.lit(0).alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["stop"], s["stop"]).alias("stop"),
            (a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(a["stop"], s["start"])))
            .alias("n")),
        lambda a: a["n"])
    found = found.select(F.col("doc").alias("_d"), F.col("txt").alias("_t"),
                         covered.alias("hit"), "items")
    all_rows = met.where("entry.size = 0").select(
        "doc", "txt", F.col("entry.start").cast("long").alias("n_words"))
    return all_rows.join(
        found, F.col("doc").eqNullSafe(F.col("_d")) & (F.col("txt") == F.col("_t")), "left").select(
        F.col("doc").alias(doc_id), "txt", "n_words",
        F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("hit") > 0, F.lit(False)).alias("contaminated"))


def digest(result: DataFrame) -> DataFrame:
    return result.withColumn("n_items", F.size("items").cast("long")).withColumn(
        "items_sha256", F.sha2(F.array_join("items", ",").cast("binary"), 256)).drop("items")
