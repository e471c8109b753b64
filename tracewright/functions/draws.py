"""Random draws as hashes of a key: the same on any cluster, partitioning or retry."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STREAM_DIGITS = 12  # hex digits per draw: 48 bits, five draws per digest


def digest(seed: str, *parts: Column) -> Column:
    """One digest per key; ``uniform`` reads up to five draws from it."""
    text = F.concat_ws("|", F.lit(seed), *[p.cast("string") for p in parts])
    return F.sha2(text, 256)


def drawn(hashed: Column, stream: int = 0) -> Column:
    """The hex digits of a draw."""
    return F.substring(hashed, 1 + STREAM_DIGITS * stream, STREAM_DIGITS)


def drawn_below(limit: float) -> str:
    """The digits that a draw sorts before exactly where its ``uniform`` is under ``limit``."""
    return f"{math.ceil(limit * 16**STREAM_DIGITS):0{STREAM_DIGITS}x}"


def uniform(hashed: Column, stream: int = 0) -> Column:
    """Uniform in [0, 1)."""
    return F.conv(drawn(hashed, stream), 16, 10).cast("double") / F.lit(float(16**STREAM_DIGITS))


def settled(df: DataFrame) -> DataFrame:
    """Have each row's columns computed once, however often later expressions use them.

    The optimizer may otherwise move a draw into a branch or lambda that uses it, where it
    is hashed again and again; it does not move expressions across a generator.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))
