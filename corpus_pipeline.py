"""The corpus pipeline: five stages over ``documents``, each written and read by the next.

Toxic documents go; of each class of near copies one row stays, that with the least id; documents that
hold a benchmark passage go; personal data is redacted; what is left is packed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import (
    op2_decontamination,
    op3_packing,
    op4_toxicity,
    op5_jaccard,
    op9_pii,
    queries,
)
from tracewright.session import durable, shared_folder


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose score is below the threshold of their language."""
    model = op4_toxicity.fit(docs, queries.table(spark, sf_dir, "labels"))
    return op4_toxicity.score(docs, model).where(~F.col("flagged")).select(*docs.columns)


def _without(docs: DataFrame, rows: DataFrame, how: str = "left_anti") -> DataFrame:
    """The documents whose id and text are not (``left_semi``: are) those of ``rows``."""
    named = rows.select(F.col("doc_id").alias("_id"), F.col("txt").alias("_txt"))
    return docs.join(named, F.col("doc_id").eqNullSafe(F.col("_id")) & (
        F.xxhash64("text") == F.col("_txt")), how)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class: that with the least id (null last), then text hash.

    Rows are told apart by id and text, so null and repeated ids are ids like others; of rows
    that share both, the least stays. Documents without words link with nothing and all stay.
    """
    rows = durable(op5_jaccard.classified(docs).where("root is not null").groupBy(
        "root", "doc_id", "txt").agg(F.count("*").alias("n")))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "txt")
    stays = rows.groupBy("root").agg(F.min(first).alias("first"))
    rows = durable(rows.join(stays, "root").select(
        "doc_id", "txt", "n", (first == F.col("first")).alias("stays")))
    repeated = rows.where("stays and n > 1")
    once = _without(_without(docs, rows.where("not stays")), repeated)
    others = [c for c in docs.columns if c != "doc_id"]
    several = _without(docs, repeated, "left_semi").groupBy(
        "doc_id", F.xxhash64("text").alias("_txt")).agg(F.min(F.struct(*others)).alias("_row"))
    return once.unionByName(several.select("doc_id", "_row.*").select(*docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows in which a benchmark window occurs, told apart by id and text."""
    bad = op2_decontamination.contaminated_rows(
        docs, queries.table(spark, sf_dir, "benchmark")).where("contaminated")
    return _without(docs, bad.select("doc_id", "txt").distinct())


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind in place of each span of personal data, and counts the characters anew."""
    return op9_pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the packed sequences."""
    return op3_packing.pack_documents(docs, queries.tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("redact", redact),
    ("pack", pack),
]

#: A trained classifier and a tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each written to the shared folder and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark).rstrip('/')}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
