"""Column expressions shared by the operators.

Durations are carried as whole microseconds, so sums do not depend on the order in which
partial aggregates meet, and turned into hours or minutes only in the last projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000
MINUTE_US = 60_000_000


def elapsed_us(start: Column, end: Column) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def whole(value: Column) -> Column:
    """``F.round(value).cast("bigint")`` of doubles, halves away from zero, without a decimal per row."""
    near = F.rint(value)
    half = F.abs(value - near) == 0.5
    return F.when(half, value + F.signum(value) * 0.5).otherwise(near).cast("bigint")


def minutes_to_us(minutes: Column) -> Column:
    return whole(minutes * F.lit(float(MINUTE_US)))


def hours_to_us(value: Column) -> Column:
    return whole(value * F.lit(float(HOUR_US)))


def hours(us: Column) -> Column:
    return us.cast("double") / F.lit(float(HOUR_US))


def minutes(us: Column) -> Column:
    return us.cast("double") / F.lit(float(MINUTE_US))


def wide_sum(us: Column) -> Column:
    """Exact sum of whole numbers; a plain bigint sum overflows at cluster scale."""
    return F.sum(us.cast("decimal(20,0)"))


def share(part: Column, whole: Column) -> Column:
    """Ratio that is null when the denominator is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def rate(condition: Column) -> Column:
    """Share of rows on which a boolean column holds."""
    return F.avg(condition.cast("int"))


def iso_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def literal_map(mapping: dict) -> Column:
    """A small fixed dictionary as a map column."""
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
