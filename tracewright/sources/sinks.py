"""Sinks: named result tables, the JSON report, record export and the relational load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.log import ProcessLog


def write_tables(tables: dict[str, DataFrame], directory: str, fmt: str = "csv") -> None:
    """One folder per table. CSV keeps a header and joins arrays with `` | ``."""
    for name, df in tables.items():
        if fmt == "csv":
            arrays = {
                f.name: F.array_join(f.name, " | ")
                for f in df.schema.fields if f.dataType.typeName() == "array"
            }
            df.withColumns(arrays).write.mode("overwrite").option("header", True).csv(
                f"{directory}/{name}"
            )
        else:
            df.write.mode("overwrite").format(fmt).save(f"{directory}/{name}")


def write_report(report: DataFrame, path: str) -> None:
    """The one-row report struct as JSON text."""
    report.select(F.to_json("report", {"pretty": "true"}).alias("value")).write.mode(
        "overwrite"
    ).text(path)


def records(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows of an ordered frame as JSON records with ISO dates, at most ``limit`` of them."""
    picked = df if limit is None else df.limit(limit)
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "ignoreNullFields": "false"}
    return picked.select(F.to_json(F.struct(*picked.columns), options).alias("record"))


def relational_form(events: DataFrame) -> DataFrame:
    """Events with the column name and the decimal types of the relational schema."""
    return events.withColumnRenamed("timestamp", "event_timestamp").withColumns({
        "amount_usd": F.col("amount_usd").cast("decimal(14,2)"),
        "processing_minutes": F.col("processing_minutes").cast("decimal(12,2)"),
    })


def relational_cases(cases: DataFrame) -> DataFrame:
    return cases.withColumns({
        "amount_usd": F.col("amount_usd").cast("decimal(14,2)"),
        "cycle_time_hours": F.col("cycle_time_hours").cast("decimal(14,4)"),
        "sla_target_hours": F.col("sla_target_hours").cast("decimal(10,2)"),
    })


def _save_by_case(df: DataFrame, table: str, order: tuple[str, ...], buckets: int) -> None:
    # One task per bucket writes one file, instead of each task one file per bucket.
    df.repartition(buckets, "case_id").write.mode("overwrite").bucketBy(
        buckets, "case_id"
    ).sortBy(*order).saveAsTable(table)


def load_relational(
    events: DataFrame, cases: DataFrame, jdbc: dict[str, str] | None = None,
    cases_table: str = "process_cases", events_table: str = "process_events",
    buckets: int | None = None, case_limit: int = ProcessLog.case_limit,
) -> None:
    """Full refresh of both tables: over JDBC with truncate, else as Spark tables.

    As Spark tables they are bucketed by case, so joins, windows and traces by case need no
    shuffle afterwards. A bucket is written and read by one task, so a log with a case above
    ``case_limit`` is range partitioned on its full order instead. ``buckets`` defaults to
    the shuffle partition setting.
    """
    typed_events, typed_cases = relational_form(events), relational_cases(cases)
    if jdbc:
        for df, table in ((typed_cases, cases_table), (typed_events, events_table)):
            df.write.format("jdbc").options(**jdbc).option("dbtable", table).option(
                "truncate", True
            ).mode("overwrite").save()
        return
    count = buckets or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    _save_by_case(typed_cases, cases_table, ("case_id",), count)
    order = ("case_id", "event_timestamp", "event_index")
    if ProcessLog(events, case_limit=case_limit).has_long_cases:
        typed_events.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(
            "overwrite"
        ).saveAsTable(events_table)
    else:
        _save_by_case(typed_events, events_table, order, count)
