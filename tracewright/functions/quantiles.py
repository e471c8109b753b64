"""Exact grouped quantiles that never hold a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.columns import wide_sum
from tracewright.session import broadcast_if_small, durable, is_small

CELL_BITS = 24
CELL_US = 1 << CELL_BITS  # 16.8 seconds: about 1.9 million cells per year of value range


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    max_groups: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Linear-interpolation quantiles of a whole-number column, per group.

    Pass one counts values per fixed-width cell (strong map-side combine) and finds, by a
    running sum over the cells of a group, the cells that hold a wanted rank. Pass two keeps
    only the rows of those cells and resolves the rank inside them. A window therefore sees
    at most the cells of one group or the distinct values of one cell, both fixed by the
    value range and not by the row count. Both passes read the same shuffle output.

    Returns ``keys``, ``n``, ``total`` and one double column per entry of ``probs``.
    ``max_groups`` is a proven bound on the number of groups; with it the wanted cells
    (at most two per probability and group) are broadcast.
    """
    keys = list(keys)
    value_col = F.col(value)
    weight_col = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    base = df.where(value_col.isNotNull()).select(
        *keys,
        value_col.cast("bigint").alias("_v"),
        F.shiftright(value_col.cast("bigint"), CELL_BITS).alias("_cell"),
        weight_col.alias("_w"),
    )
    counted = F.sum("_w").cast("bigint")
    summed = wide_sum(F.col("_v") * F.col("_w")) if weight else wide_sum(F.col("_v"))
    cells = base.groupBy(*keys, "_cell").agg(counted.alias("_n"), summed.alias("_sum"))
    targets = _targets(cells, keys, probs)
    bound = None if max_groups is None else max_groups * 2 * len(probs)
    if not is_small(bound):
        # The join may shuffle, and one cell may hold most rows: count its values first.
        base = base.groupBy(*keys, "_cell", "_v").agg(counted.alias("_w"))
    hits = _same_cell(base, broadcast_if_small(targets, bound), keys).select("t.*", "b._v", "b._w")
    values = hits.groupBy(*keys, "_cell", "_before", "_rows", "_total", "_v").agg(
        counted.alias("_n")
    )
    return _picked(values, keys, probs)


def lane_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    weights: Sequence[str],
    lane: str,
    max_groups: int | None = None,
) -> DataFrame:
    """``exact_quantiles`` of every group once per column of ``weights``; a null weight leaves a row out.

    Rows are counted with all their weights side by side, in a sum per column, and become a row per
    weight (its place is the column ``lane``) only as cells or values that are counted already. So the work
    follows the rows and not the weighted rows. ``max_groups`` bounds groups times weights.
    """
    keys, lanes = list(keys), range(len(weights))
    value_col = F.col(value)
    base = df.where(value_col.isNotNull()).select(
        *keys,
        value_col.cast("bigint").alias("_v"),
        F.shiftright(value_col.cast("bigint"), CELL_BITS).alias("_cell"),
        *[F.col(w).cast("bigint").alias(f"_w{i}") for i, w in enumerate(weights)],
    )
    counted = [F.sum(f"_w{i}").alias(f"_n{i}") for i in lanes]
    # Below the cell's width, so that these sums stay whole numbers of 64 bits.
    above = F.col("_v").bitwiseAND(F.lit(CELL_US - 1))
    summed = [F.sum(above * F.col(f"_w{i}")).alias(f"_s{i}") for i in lanes]
    start = F.col("_cell").cast("decimal(12,0)") * F.lit(CELL_US)
    cells = base.groupBy(*keys, "_cell").agg(*counted, *summed)
    cells = by_lane(cells, [*keys, "_cell"], {"_n": "_n{}", "_s": "_s{}"}, lane, lanes).where(
        "_n IS NOT NULL").select(
        *keys, lane, "_cell", "_n", (start * F.col("_n") + F.col("_s")).alias("_sum"))
    keyed = [*keys, lane]
    # Read twice, and the second time without the totals.
    targets = durable(_targets(cells, keyed, probs))
    bound = None if max_groups is None else max_groups * 2 * len(probs)
    wanted = broadcast_if_small(targets.select(*keys, "_cell").distinct(), bound)
    values = _same_cell(base, wanted, keys, "left_semi").groupBy(*keys, "_cell", "_v").agg(*counted)
    values = by_lane(values, [*keys, "_cell", "_v"], {"_n": "_n{}"}, lane, lanes).where(
        "_n IS NOT NULL")
    hits = _same_cell(values, broadcast_if_small(targets, bound), keyed).select("t.*", "b._v", "b._n")
    return _picked(hits, keyed, probs)


def by_lane(
    table: DataFrame, keep: Sequence[str], columns: dict[str, str], lane: str, lanes: Sequence[int]
) -> DataFrame:
    """A row per lane: ``columns`` maps a name to the pattern of the names it has side by side."""
    rows = [F.struct(F.lit(i).alias(lane), *[
        F.col(pattern.format(i)).alias(name) for name, pattern in columns.items()]) for i in lanes]
    return table.select(*keep, F.inline(F.array(*rows)))


def _spots(probs: dict[str, float]) -> dict[str, Column]:
    return {name: (F.col("_rows") - 1) * F.lit(float(p)) for name, p in probs.items()}


def _holds(rank: Column) -> Column:
    return (F.col("_before") <= rank) & (rank < F.col("_after"))


def _targets(cells: DataFrame, keys: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """Of counted cells those that hold a wanted rank, with the rows before them."""
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cells.select(
        *keys,
        "_cell",
        (F.sum("_n").over(upto) - F.col("_n")).alias("_before"),
        F.sum("_n").over(upto).alias("_after"),
        F.sum("_n").over(group).alias("_rows"),
        F.sum("_sum").over(group).alias("_total"),
    )
    wanted = F.lit(False)
    for position in _spots(probs).values():
        wanted = wanted | _holds(F.floor(position)) | _holds(F.ceil(position))
    return placed.where(wanted).drop("_after")


def _same_cell(
    rows: DataFrame, cells: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """``rows`` as ``b`` joined with ``cells`` as ``t``."""
    match = F.col("b._cell") == F.col("t._cell")
    for key in keys:
        match = match & F.col(f"b.{key}").eqNullSafe(F.col(f"t.{key}"))
    return rows.alias("b").join(cells.alias("t"), match, how)


def _picked(values: DataFrame, keys: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """The quantiles from the counted values of the wanted cells."""
    within = Window.partitionBy(*keys, "_cell").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranked = (
        values.withColumn("_after", F.col("_before") + F.sum("_n").over(within))
        .withColumn("_before", F.col("_after") - F.col("_n"))
    )
    spot = _spots(probs)
    picks = []
    for name, position in spot.items():
        picks.append(F.max(F.when(_holds(F.floor(position)), F.col("_v"))).alias(f"_lo_{name}"))
        picks.append(F.max(F.when(_holds(F.ceil(position)), F.col("_v"))).alias(f"_hi_{name}"))
    picked = ranked.groupBy(*keys, "_rows", "_total").agg(*picks)
    out = []
    for name, position in spot.items():
        low, high = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        out.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return picked.select(*keys, F.col("_rows").alias("n"), F.col("_total").alias("total"), *out)
