"""An event log together with the size facts the operators choose their plan by."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.session import broadcast_if_small, durable

TASK_ROWS = 250_000


@dataclass(frozen=True)
class LogFacts:
    events: int
    cases: int
    longest_case: int


@dataclass
class ProcessLog:
    """Events in the canonical schema with the order they have inside a case.

    A case of up to ``case_limit`` events is one task's work; longer ones are cut into segments
    of about ``segment_rows``. What works on whole cases deals them to tasks of about
    ``TASK_ROWS`` events. All three only choose the plan: every operator gives the same rows under
    any values.

    ``traces`` are the arrays of ``discovery.trace_arrays`` where a caller with several readers has
    written them down. They are of these events: ``replace`` leaves them out.
    """

    events: DataFrame
    order: tuple[str, ...] = ("timestamp", "event_index")
    case_limit: int = 100_000
    segment_rows: int = 2_000_000
    traces: DataFrame | None = field(default=None, init=False)

    @cached_property
    def facts(self) -> LogFacts:
        """Sizes from one pre-aggregated job; only three numbers reach the driver."""
        per_case = self.events.groupBy("case_id").agg(F.count(F.lit(1)).alias("n"))
        row = per_case.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("events"),
            F.count(F.lit(1)).alias("cases"),
            F.coalesce(F.max("n"), F.lit(0)).alias("longest"),
        ).first()
        return LogFacts(row["events"], row["cases"], row["longest"])

    @cached_property
    def activity_count(self) -> int:
        """Number of activity labels: the bound behind every per-activity broadcast."""
        return self.events.select("activity").distinct().count()

    @property
    def has_long_cases(self) -> bool:
        return self.facts.longest_case > self.case_limit

    @cached_property
    def _long_ids(self) -> DataFrame:
        ids = self.events.groupBy("case_id").agg(F.count(F.lit(1)).alias("n"))
        ids = durable(ids.where(F.col("n") > self.case_limit).select("case_id"))
        # At most events / case_limit cases can be that long.
        return broadcast_if_small(ids, self.facts.events // self.case_limit)

    @property
    def regular(self) -> DataFrame:
        """Events of the cases that one task can hold."""
        if not self.has_long_cases:
            return self.events
        return self.events.join(self._long_ids, "case_id", "left_anti")

    @property
    def long_events(self) -> DataFrame:
        """Events of the cases that one task cannot hold."""
        return self.events.join(self._long_ids, "case_id", "left_semi")

    def dealt(self, rows: DataFrame) -> DataFrame:
        """``rows`` by case, in as many parts as keep a task's share of the log at ``TASK_ROWS`` events.

        Only for rows without long cases. A task sorts or gathers what it gets, and without this
        its memory follows the session's partition size. Logs of one part stay as they are.
        """
        parts = -(-self.facts.events // TASK_ROWS)
        return rows.repartition(parts, "case_id") if parts > 1 else rows

    @cached_property
    def segments(self) -> DataFrame:
        """Events of the long cases, cut into balanced runs of the total order.

        Adds ``segment``, the number of the range the row fell in, and ``position``, its
        1-based place in the case. Range partitioning on the full order splits a case of
        any size, and rows that share a timestamp, evenly.
        """
        order = ("case_id", *self.order)
        # At least as many ranges as tasks can run; boundary rows stay one per case and range.
        tasks = int(self.events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranges = max(tasks, -(-self.facts.events // self.segment_rows))
        cut = durable(
            self.long_events.repartitionByRange(ranges, *order)
            .withColumn("segment", F.spark_partition_id())
        )
        inside = Window.partitionBy("case_id", "segment").orderBy(*self.order)
        before = (
            Window.partitionBy("case_id").orderBy("segment")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        # One row per case and range.
        sizes = cut.groupBy("case_id", "segment").agg(F.count(F.lit(1)).alias("_n"))
        offsets = sizes.select(
            "case_id", "segment", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
        )
        return (
            cut.withColumn("_row", F.row_number().over(inside))
            .join(offsets, ["case_id", "segment"])
            .withColumn("position", F.col("_offset") + F.col("_row"))
            .drop("_row", "_offset")
        )

    def numbered(self, *columns: str) -> DataFrame:
        """``columns`` and the 1-based ``position`` of each event in its case."""
        window = Window.partitionBy("case_id").orderBy(*self.order)
        used = dict.fromkeys(("case_id", *self.order, *columns))
        rows = self.dealt(self.regular.select(*used)).select(
            *columns, F.row_number().over(window).alias("position"))
        if self.has_long_cases:
            rows = rows.unionByName(self.segments.select(*columns, "position"))
        return rows

    def linked(self, *columns: str, previous: tuple[str, ...]) -> DataFrame:
        """Case, ``columns`` and the struct ``before`` with ``previous`` of the event before it.

        ``before`` is null on the first event of a case. One shuffle by case for regular
        cases; long cases look back by window inside a segment and, on the first row of a
        segment, to the last row of the segment before it.
        """
        columns = tuple(dict.fromkeys(("case_id", *columns)))

        def looked_back(df, *keys, name):
            # One lag per plain column: a lag over a struct would put the struct, and so
            # every column in it a second time, into the shuffle.
            window = Window.partitionBy("case_id", *keys).orderBy(*self.order)
            marked = df.select(
                *columns, *keys, F.lag(F.lit(1)).over(window).alias("_any"),
                *[F.lag(c).over(window).alias(f"_{c}") for c in previous],
            )
            before = F.struct(*[F.col(f"_{c}").alias(c) for c in previous])
            return marked.select(
                *columns, *keys, F.when(F.col("_any").isNotNull(), before).alias(name)
            )

        used = dict.fromkeys((*columns, *previous, *self.order))
        rows = looked_back(self.dealt(self.regular.select(*used)), name="before")
        if not self.has_long_cases:
            return rows
        across = Window.partitionBy("case_id").orderBy("segment")
        near = looked_back(self.segments, "segment", name="near")
        # One row per case and segment.
        tails = self.segments.groupBy("case_id", "segment").agg(
            F.max_by(F.struct(*previous), F.struct(*self.order)).alias("tail")
        )
        far = tails.select("case_id", "segment", F.lag("tail").over(across).alias("far"))
        stitched = near.join(far, ["case_id", "segment"], "left")
        return rows.unionByName(
            stitched.select(*columns, F.coalesce("near", "far").alias("before"))
        )
