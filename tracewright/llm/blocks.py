"""Texts dealt into blocks, and questions that blocks ask of all others.

Each block asks about a key at most twice (twice tells that the key repeats inside the block),
so a key that a third of all rows hold reaches the task that answers per block, not per row. Keys travel as packed arrays;
Spark partitions, shuffles and groups them. Block and part sizes follow the input, so that
no group grows with it.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASKED = "part int, block int, keys binary, more binary"


def block_count(texts: DataFrame, text: str, block_bytes: int) -> int:
    """Blocks of about ``block_bytes`` each; one aggregate over the text lengths."""
    total = texts.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0
    return max(1, -(-total // block_bytes))


def dealt(texts: DataFrame, blocks: int, *columns: str) -> DataFrame:
    """The columns and the block of each row, by a hash of them all (stable on a rerun)."""
    columns = tuple(dict.fromkeys(columns))
    return texts.select(
        *columns,
        F.pmod(F.xxhash64(*columns), F.lit(blocks)).cast("int").alias("block"))


def parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (keys >> np.uint64(20)) % np.uint64(parts)


def ask(block: int, parts: int, keys: np.ndarray, more: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows that carry ``keys`` (each twice at most) to the parts that answer for them."""
    owner = parts_of(keys, parts)
    order = np.argsort(owner, kind="stable")
    owner = owner[order]
    cuts = np.flatnonzero(np.diff(owner, prepend=owner[:1] - np.uint64(1))) if len(owner) else []
    ends = [*cuts[1:], len(owner)] if len(owner) else []
    keys = keys[order]
    more = keys[:0] if more is None else more[order]
    return pa.RecordBatch.from_arrays([
        pa.array([int(owner[a]) for a in cuts], pa.int32()),
        pa.array([block] * len(cuts), pa.int32()),
        pa.array([keys[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
        pa.array([more[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
    ], names=["part", "block", "keys", "more"])


def unpack(column: pa.ChunkedArray, dtype=np.uint64) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype=dtype) for x in column]


def joined(arrays: list[np.ndarray], dtype=np.uint64) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, dtype=dtype)


def shared_keys(asked: DataFrame) -> DataFrame:
    """For each block, those of its keys that were asked about more than once.

    ``more`` holds further 64 bits of each key, or nothing.
    """

    def answer(table: pa.Table) -> pa.Table:
        keys, more = unpack(table["keys"]), unpack(table["more"])
        sizes = [len(x) for x in keys]
        first, second = joined(keys), joined(more)
        order = np.lexsort((second, first)) if len(second) else np.argsort(first, kind="stable")
        same = first[order][1:] == first[order][:-1]
        if len(second):
            same &= second[order][1:] == second[order][:-1]
        repeated = np.zeros(len(first), dtype=bool)
        repeated[order[1:]] |= same
        repeated[order[:-1]] |= same
        ends = np.cumsum(sizes)
        out = [(b, k[repeated[e - n:e]], m[repeated[e - n:e]] if len(m) else m)
               for b, k, m, n, e in zip(table["block"].to_pylist(), keys, more, sizes, ends,
                                        strict=True)]
        out = [x for x in out if len(x[1])]
        return pa.table({
            "block": pa.array([b for b, _, _ in out], pa.int32()),
            "keys": pa.array([k.tobytes() for _, k, _ in out], pa.binary()),
            "more": pa.array([m.tobytes() for _, _, m in out], pa.binary()),
        })

    return asked.groupBy("part").applyInArrow(answer, "block int, keys binary, more binary")


def by_block(texts: DataFrame, function: Callable[[pa.Table], pa.Table], schema) -> DataFrame:
    return texts.groupBy("block").applyInArrow(function, schema)


def with_answers(
    texts: DataFrame, answers: DataFrame,
    function: Callable[[pa.Table, pa.Table], pa.Table], schema,
) -> DataFrame:
    """``function`` of each block's texts and of the answers that came back to it."""
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(function, schema)


def trim() -> None:
    """Gives this process's free memory back to the system. A worker outlives its task by a minute or
    serves the next one, and what it keeps counts beside that of the stages that follow."""
    pa.default_memory_pool().release_unused()
    if free := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        free(0)


def slices(table: pa.Table, column: str, limit: int) -> Iterator[pa.Table]:
    """Runs of rows with about ``limit`` bytes of text each, one row at least. Memory that the work
    on them has left free is given back at the end."""
    sizes = pc.fill_null(pc.binary_length(table[column]), 0).to_numpy().astype(np.int64)
    at, n = 0, len(sizes)
    total = np.concatenate(([0], np.cumsum(sizes)))
    while at < n:
        to = max(at + 1, int(np.searchsorted(total, total[at] + limit, side="right")) - 1)
        yield table.slice(at, to - at)
        at = to
    trim()
