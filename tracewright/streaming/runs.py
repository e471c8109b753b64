"""Run-log monitoring on a stream: the batch plans behind a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracewright.model import RUN_SCHEMA
from tracewright.operators.monitoring import low_sessions, runs_by_window


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """New Parquet files of the run table as a stream."""
    return spark.readStream.schema(RUN_SCHEMA).parquet(path)


def runs_by_window_stream(
    runs: DataFrame, size: str = "1 hour", late: str = "10 minutes"
) -> DataFrame:
    """Runs per status and window; a window is final once the watermark passes its end."""
    return runs_by_window(runs.withWatermark("ts", late), size)


def failure_rate_stream(
    runs: DataFrame, size: str = "15 minutes", slide: str = "1 minute", late: str = "10 minutes"
) -> DataFrame:
    """Sliding failure counts: each row is a window with at least one failure."""
    failures = runs.where("status = 'failure'").withWatermark("ts", late)
    return runs_by_window(failures, size, slide)


def hold_alerts_stream(
    samples: DataFrame, value: str, threshold: float, hold_minutes: int, gap_seconds=90,
    by: tuple[str, ...] = ("instance",), late: str = "10 minutes",
) -> DataFrame:
    """Hold alerts, each emitted once when the watermark passes the end of its session."""
    return low_sessions(
        samples.withWatermark("ts", late), value, threshold, hold_minutes, gap_seconds, by)


def write_table(stream: DataFrame, path: str, checkpoint: str):
    """Append finished windows to a Parquet table, exactly once."""
    return (
        stream.writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )
