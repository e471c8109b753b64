"""File scans: event log, case master, resource dimension, target path, BPMN model."""

from __future__ import annotations

import uuid
from functools import reduce
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.model import IDEAL_PROCESS_SCHEMA, RESOURCE_SCHEMA
from tracewright.session import durable, shared_folder


def _raw_csv(spark: SparkSession, path: str) -> DataFrame:
    # Names come from the header, so a file may carry its columns in any order and have
    # more of them. The values stay text for the contract rules. Files of one folder must agree
    # on the header: a file with another one is an error, not read by position.
    return spark.read.option("header", True).option("inferSchema", False).option(
        "enforceSchema", False).csv(path)


def scan_events_csv(spark: SparkSession, path: str) -> DataFrame:
    """Event log from CSV (gzip by extension), as text; ``contracts.validate_events`` types it.

    A gzip file is read by one task. At scale, store the log as many files or as Parquet.
    """
    return _raw_csv(spark, path)


def scan_cases_csv(spark: SparkSession, path: str) -> DataFrame:
    return _raw_csv(spark, path)


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Typed columnar table, e.g. a validated log written earlier."""
    return spark.read.format(fmt).load(path)


def scan_resources_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESOURCE_SCHEMA).option("header", True).csv(path)


def scan_ideal_process(spark: SparkSession, path: str) -> DataFrame:
    """One row: process, version, ordered activities, SLA targets by priority."""
    return spark.read.schema(IDEAL_PROCESS_SCHEMA).option("multiLine", True).json(path)


# BPMN element types that stand for a task.
BPMN_TASK_TYPES = (
    "businessRuleTask", "manualTask", "receiveTask", "scriptTask", "sendTask",
    "serviceTask", "task", "userTask",
)
# BPMN element types that route or mark, without work of their own.
BPMN_SILENT_TYPES = (
    "complexGateway", "eventBasedGateway", "exclusiveGateway", "inclusiveGateway",
    "parallelGateway", "boundaryEvent", "endEvent", "intermediateCatchEvent",
    "intermediateThrowEvent", "startEvent",
)
_NODE = T.StructType([T.StructField("_id", T.StringType()), T.StructField("_name", T.StringType())])
_FLOW = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("_sourceRef", T.StringType()),
    T.StructField("_targetRef", T.StringType()),
])


def _bpmn_rows(spark: SparkSession, path: str, tag: str, schema: T.StructType, prefix: str):
    return (
        spark.read.format("xml").schema(schema)
        .option("rowTag", f"{prefix}{tag}").load(path)
    )


def scan_bpmn_nodes(spark: SparkSession, path: str, prefix: str = "bpmn:") -> DataFrame:
    """Tasks, gateways and events: ``node_id, name, node_type, is_task``."""
    tags = (*BPMN_TASK_TYPES, *BPMN_SILENT_TYPES)
    parts = [
        _bpmn_rows(spark, path, tag, _NODE, prefix).select(
            F.col("_id").alias("node_id"),
            F.col("_name").alias("name"),
            F.lit(tag).alias("node_type"),
            F.lit(tag in BPMN_TASK_TYPES).alias("is_task"),
        )
        for tag in tags
    ]
    return reduce(DataFrame.unionByName, parts)


def scan_bpmn_flows(spark: SparkSession, path: str, prefix: str = "bpmn:") -> DataFrame:
    return _bpmn_rows(spark, path, "sequenceFlow", _FLOW, prefix).select(
        F.col("_id").alias("flow_id"),
        F.col("_sourceRef").alias("source_id"),
        F.col("_targetRef").alias("target_id"),
    )


def bpmn_task_edges(nodes: DataFrame, flows: DataFrame) -> DataFrame:
    """Task-to-task edges of the model: one task leads to another where flows connect them with
    nothing but gateways and events in between, through any number of them and around any cycle.

    A fixpoint over (task, node) pairs: each round follows the flows out of the silent nodes
    that the last round reached for the first time, so a cycle ends it, and the rounds are as
    many as the longest way between two tasks. Any node that is no task is silent.
    """
    tasks = nodes.where("is_task").select("node_id", "name")
    source = tasks.select(F.col("node_id").alias("source_id"), F.col("name").alias("source"))
    target = tasks.select(F.col("node_id").alias("target_id"), F.col("name").alias("target"))
    steps = durable(flows.select("source_id", "target_id").distinct())
    onward = steps.join(source, "source_id", "left_anti").select(
        F.col("source_id").alias("target_id"), F.col("target_id").alias("next_id"))
    fresh = reached = durable(steps.join(source.select("source_id"), "source_id", "left_semi"))
    while not fresh.isEmpty():
        hops = fresh.join(onward, "target_id").select(
            "source_id", F.col("next_id").alias("target_id")).distinct()
        fresh = durable(hops.join(reached, ["source_id", "target_id"], "left_anti"))
        reached = durable(reached.unionByName(fresh))
    edges = reached.join(source, "source_id").join(target, "target_id")
    return edges.select("source", "target").distinct()


def packaged_model(spark: SparkSession, name: str) -> str:
    """Path of a model of this package, copied to where all executors can read it."""
    text = resources.files("tracewright.sources").joinpath(name).read_text(encoding="utf-8")
    path = f"{shared_folder(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def scan_text_files(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files for the secret scan: ``doc, text``."""
    return spark.read.option("wholetext", True).text(path).select(
        F.input_file_name().alias("doc"), F.col("value").alias("text")
    )
