"""Global ordered rank and running sums without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.session import durable

_PART = "_range_part"


def global_prefix(
    df: DataFrame,
    order: Sequence[Column],
    sums: Sequence[str] = (),
    rank: str = "rank",
) -> DataFrame:
    """Add a 1-based global ``rank`` and, per column in ``sums``, ``cum_*`` and ``total_*``.

    Rows are range partitioned on ``order`` (one shuffle, balanced by Spark's own sampling),
    each range keeps its number, ranges contribute one row of totals, and the totals of the
    ranges before it shift what a window inside a range has counted. The only single-task
    step sees one row per range.
    """
    ranged = durable(
        df.repartitionByRange(*order).withColumn(_PART, F.spark_partition_id())
    )
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy()
    measures = {f"_{c}": F.sum(c) for c in sums}
    totals = ranged.groupBy(_PART).agg(
        F.count(F.lit(1)).alias("_rows"), *[e.alias(n) for n, e in measures.items()]
    )
    offsets = totals.select(
        _PART,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}_before") for c in sums],
        *[F.sum(f"_{c}").over(everywhere).alias(f"total_{c}") for c in sums],
    )
    inside = Window.partitionBy(_PART).orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per range partition: bounded by the shuffle partition setting.
    joined = ranged.join(F.broadcast(offsets), _PART)
    out = joined.withColumn(rank, F.col("_rows_before") + F.row_number().over(inside))
    for c in sums:
        out = out.withColumn(f"cum_{c}", F.col(f"_{c}_before") + F.sum(c).over(running))
    return out.drop(_PART, "_rows_before", *[f"_{c}_before" for c in sums])
