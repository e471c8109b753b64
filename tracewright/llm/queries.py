"""The corpus operators as registered queries over whole tables, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import (
    op1_substrings,
    op2_decontamination,
    op3_packing,
    op4_toxicity,
    op5_jaccard,
    op6_token_counts as op6,
    op7_language_model,
    op8_neighbours,
    op9_pii,
    op10_chat,
    op11_hard_negatives,
    op12_divergence,
    op13_token_store,
)

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Rows of a batch that goes to Python, so that long texts do not fill its memory.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(divisor: int):
    """CRC-32 of the document id as text, modulo ``divisor``; a null id is an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % divisor


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_substrings.digest(
        op1_substrings.remove_repeats(table(spark, sf_dir, "documents")))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_decontamination.digest(op2_decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held = remainder(3) == 1
    model = op4_toxicity.fit(
        documents.where(~held), table(spark, sf_dir, "labels").where(~held))
    return op4_toxicity.score(documents.withColumn("held_out", held), model).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "flagged")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_jaccard.similar_classes(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = op6.write_token_files(table(spark, sf_dir, "documents"), tokenizer_path())
    shard = F.regexp_extract("file", r"part-(\d+)", 1).cast("int")
    return op6.token_counts(spark, folder).select(
        shard.alias("shard"), "document", "start", "n_tokens", "ended")


def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn("_train", remainder(5) != 1)
    tree = op7_language_model.fit_tree(documents.where("_train"))
    return op7_language_model.score(documents, "_train", tree, keep=("doc_id", "_train")).select(
        "doc_id", (~F.col("_train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_pii.digest(op9_pii.find_pii(table(spark, sf_dir, "documents")))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"))
    windows = op10_chat.format_windows(conversations.unionByName(extra))
    return op10_chat.read_back(windows)


def op11_mine_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return op11_hard_negatives.hard_negatives(
        table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_divergence.audit(table(spark, sf_dir, "documents"))


def op13_token_store_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = op13_token_store.write_store(table(spark, sf_dir, "documents"), tokenizer_path())
    return store.measured(store.locate(store.keys(spark))).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "copy")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_substring_dedup, op2_decontaminate, op3_best_fit_packing, op4_toxic,
        op5_ngram_jaccard, op6_token_counts, op7_suffix_tree, op8_nearest, op9_personal_data,
        op10_chat_format, op11_mine_negatives, op12_source_divergence, op13_token_store_ids)}


def oracle_queries() -> dict[str, str]:
    return {"op11_mine_negatives": MINE_NEGATIVES, "op12_source_divergence": SOURCE_DIVERGENCE}


MINE_NEGATIVES = """
WITH valid AS (
  SELECT DISTINCT vec_id, embedding,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, label, i, CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM valid, unnest(range(1, len(embedding) + 1)) AS r(i)),
scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(sum(a.x * c.x) AS BIGINT) AS score
  FROM parts a JOIN parts c ON a.i = c.i AND a.vec_id <> c.vec_id
  WHERE a.vec_id % 100 = 0 GROUP BY a.vec_id, c.vec_id, a.label, c.label),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
       AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 10
"""

#: Dense: every group gives every kept term a share, and every pair of groups meets on all terms.
SOURCE_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs),
counted AS (SELECT d, lang, source, term, count(*) AS n FROM words GROUP BY ALL),
kept AS (
  SELECT lang, term, sum(n) AS n FROM counted GROUP BY lang, term HAVING count(*) >= 10),
sizes AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
own AS (
  SELECT c.lang, c.source, c.term, sum(c.n) AS n FROM counted c JOIN kept k
    ON k.lang = c.lang AND k.term = c.term GROUP BY ALL),
sums AS (SELECT lang, source, sum(n) AS n FROM own GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
    1 + (1000000000 * (coalesce(o.n, 0) + 2)) // (coalesce(s.n, 0) + 2 * z.v) AS p,
    1 + (1000000000 * (k.n + 2)) // (z.n + 2 * z.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes z ON z.lang = g.lang
  LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY ALL) f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
found AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found
QUALIFY part = 'pair'
  OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 10
"""
