"""The key at a rank, by counting: no global sort, no rank over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 4096
FEW_ROWS = 10_000


def _at(counts: list[tuple], rank: int) -> tuple:
    """Of ordered (cell, rows) pairs the cell that holds the 1-based rank, its rows, and the rank
    inside it."""
    for cell, rows in counts:
        if rank <= rows:
            return cell, rows, rank
        rank -= rows
    raise ValueError("rank beyond the rows")


def select_key(df: DataFrame, number: str, text: str, rank: int) -> tuple[int, str]:
    """The ``rank``-th smallest (whole number, text) pair of ``df``, counted from 1.

    Rounds of histograms: each counts the rows of at most ``CELLS`` cells of the range that holds the
    rank and goes on inside one cell, so a round shuffles cells, not rows, and reaches a single
    number after a few. Among the rows of that number, texts are told apart two characters at a
    time in the same way. Once few rows are left, the smallest of them are taken.
    """
    rows = df.select(F.col(number).cast("bigint").alias("n"), F.col(text).alias("t"))
    low, high, left = rows.agg(F.min("n"), F.max("n"), F.count(F.lit(1))).first()

    def taken():
        if left <= FEW_ROWS:
            return tuple(rows.orderBy("n", "t").limit(rank).agg(F.max(F.struct("n", "t"))).first()[0])
        return None

    while low < high and left > FEW_ROWS:
        width = -(-(high - low + 1) // CELLS)
        cell = F.floor((F.col("n") - F.lit(low)) / F.lit(width)).cast("int")
        counts = rows.groupBy(cell.alias("c")).agg(F.count(F.lit(1)).alias("k")).orderBy("c").collect()
        found, left, rank = _at([tuple(r) for r in counts], rank)
        low, high = low + found * width, min(high, low + (found + 1) * width - 1)
        rows = rows.where(F.col("n").between(low, high))
    prefix = ""
    while left > FEW_ROWS:
        # "" is a text that ends here: it sorts before all that go on.
        step = F.substring("t", len(prefix) + 1, 2)
        counts = rows.groupBy(step.alias("c")).agg(F.count(F.lit(1)).alias("k")).collect()
        found, left, rank = _at(sorted((tuple(r) for r in counts), key=lambda r: r[0].encode()), rank)
        prefix += found
        rows = rows.where(step == found)
        if len(found) < 2:
            return low, prefix
    return taken()
