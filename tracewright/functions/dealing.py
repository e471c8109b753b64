"""Tables that meet by a key, cut so that a task's share follows their rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.log import TASK_ROWS

#: A part with so many times its share is one that a few keys fill.
HEAVY = 4

Cut = Callable[..., list[tuple[DataFrame, ...]]]


def cut_by(key: str, *counted: DataFrame, task_rows: int | None = None) -> Cut:
    """A function that cuts tables into pieces; rows of one ``key`` are all in one piece.

    ``counted`` are the tables with the most rows: a task's share of them is about ``task_rows``.
    One piece is dealt by key into that many parts, whatever the session's partition size. Keys with a
    multiple of a task's rows are in another, which stays as it is: there Spark plans the join and
    splits what is skewed, as it does not for rows that were dealt. Tables of one part are one
    piece, as they are.
    """
    task_rows = task_rows or TASK_ROWS
    keys = [table.select(key) for table in counted]
    parts = -(-sum(table.count() for table in keys) // task_rows)
    if parts <= 1:
        return lambda *tables: [tables]
    part = F.pmod(F.xxhash64(key), F.lit(parts))
    sizes = reduce(DataFrame.unionAll, keys).groupBy(part.alias("part")).count()
    # At most parts / HEAVY numbers.
    heavy = [r["part"] for r in sizes.where(F.col("count") > HEAVY * task_rows).collect()]

    def cut(*tables):
        if not heavy:
            return [tuple(t.repartition(parts, key) for t in tables)]
        return [tuple(t.where(~part.isin(heavy)).repartition(parts, key) for t in tables),
                tuple(t.where(part.isin(heavy)) for t in tables)]

    return cut
