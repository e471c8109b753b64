"""Packing: a configuration linear program over the length histogram, then rounded."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.llm import blocks as B
from tracewright.llm.tokens import BLOCK, PIECES, encoder
from tracewright.llm.words import blobs
from tracewright.session import durable

PIECE = "piece int, start long, length long, ids_crc32 long"


# ---- tokens -------------------------------------------------------------------------------


def pieces(
    documents: DataFrame, tokenizer: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
    capacity: int = 4096, end_id: int = 1,
) -> DataFrame:
    """Each document's ids with ``end_id`` behind them, cut into pieces of ``capacity``."""
    kinds = dict(documents.dtypes)
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in B.slices(pa.Table.from_batches([batch]), text, 1 << 20):
                rows, out = [], []
                ids, counts = encoder(tokenizer, PIECES).encode(blobs(part[text]), BLOCK)
                every, stops = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
                for row, (low, high) in enumerate(zip([0, *stops], stops, strict=False)):
                    raw = every[low:high] + end
                    for number, at in enumerate(range(0, len(raw), 4 * capacity)):
                        own = raw[at:at + 4 * capacity]
                        rows.append(row)
                        out.append((number, at // 4, len(own) // 4, zlib.crc32(own)))
                kept = part.select(list(keep)).take(pa.array(rows, pa.int64()))
                columns = list(zip(*out, strict=True)) if out else [[]] * 4
                yield from pa.table({
                    **{f"c{i}": kept[name] for i, name in enumerate(keep)},
                    "piece": pa.array(columns[0], pa.int32()),
                    **{name: pa.array(columns[i], pa.int64()) for i, name in
                       enumerate(("start", "length", "ids_crc32"), start=1)},
                }).combine_chunks().to_batches()

    schema = ", ".join([*(f"c{i} {kinds[name]}" for i, name in enumerate(keep)), PIECE])
    return documents.select(*dict.fromkeys((*keep, text))).mapInArrow(cut, schema)


# ---- the plan, from the histogram alone ----------------------------------------------------


def _price(prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack over capacities: the best value of each, and the length that was put in last.
    Of equal values the longest length; 0 stands for room left over."""
    best = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        values = prices[room:0:-1] + best[:room]  # lengths room, room - 1, ..., 1
        at = int(values.argmax())
        if values[at] > best[room - 1] + 1e-12:
            best[room], last[room] = values[at], room - at
        else:
            best[room] = best[room - 1]
    return best, last


def _columns(lengths: np.ndarray, last: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """For each length the best bin that holds it."""
    room = capacity - lengths
    steps = [lengths]
    while True:
        item = last[room]
        stuck = (item == 0) & (room > 0)
        room = np.where(stuck, room - 1, room)
        if not item.any() and not stuck.any():
            break
        if item.any():
            steps.append(item)
        room = room - item
    matrix = -np.sort(-np.stack(steps, axis=1), axis=1)
    return [tuple(row[row > 0].tolist()) for row in matrix]


def fractional(counts: dict[int, int], capacity: int, rounds: int = 24, rate: float = 1.0):
    """Bins and how often to use each, by multiplicative weights.

    Prices start at the share of a bin that a length fills. In each round the knapsack prices
    a bin for every length that lags behind its schedule; bins within a thousandth of the best
    value are used for what lags, and prices of lagging lengths rise, those of leading ones fall.
    """
    lengths = np.array(sorted(counts), dtype=np.int64)
    need = np.array([counts[x] for x in lengths.tolist()], dtype=np.float64)
    number = {x: i for i, x in enumerate(lengths.tolist())}
    prices = np.full(capacity + 1, -1.0)
    prices[lengths] = lengths / capacity
    done = np.zeros(len(lengths))
    use: dict[tuple[int, ...], float] = defaultdict(float)
    for turn in range(1, rounds + 1):
        best, last = _price(prices, capacity)
        columns = _columns(lengths, last, capacity)
        due = need * turn / rounds
        worth = prices[lengths] + best[capacity - lengths]
        for i in np.argsort(-lengths):
            lag = due[i] - done[i]
            if lag <= 0 or (worth[i] < 0.999 * best[capacity] and turn < rounds):
                continue
            column = columns[i]
            amount = lag / column.count(int(lengths[i]))
            use[column] += amount
            for item in column:
                done[number[item]] += amount
        prices[lengths] *= np.exp(rate * np.clip((due - done) / need, -1, 1))
        prices[lengths] /= max(1e-9, (prices[lengths] * need).sum() / (lengths * need).sum() * capacity)
    return use


def plan_bins(counts: dict[int, int], capacity: int = 4096, rounds: int = 24) -> list[tuple]:
    """Groups of equal bins ``(times, ((length, copies), ...))`` that hold the histogram exactly.

    Whole uses of the fractional solution first, then best fit by decreasing length of what is
    left, into the room of any bin. All work is on groups, so it is bounded by the number of
    lengths and rounds, not of pieces.
    """
    left = {x: n for x, n in counts.items() if n}
    groups: list[tuple] = []
    if capacity in left:
        groups.append((left.pop(capacity), ((capacity, 1),), 0))
    if left:
        use = fractional(left, capacity, rounds)
        # A twentieth stays for the best fit: short pieces that close its last bins.
        for column, amount in sorted(use.items(), key=lambda x: (-x[1], x[0])):
            copies = [(x, column.count(x)) for x in dict.fromkeys(column)]
            times = min([int(0.95 * amount), *(left[x] // c for x, c in copies)])
            if times:
                groups.append((times, tuple(copies), capacity - sum(column)))
                for x, c in copies:
                    left[x] -= c * times
    room: dict[int, list] = defaultdict(list)
    full, mask = [], 0

    def put(times, items, free):
        nonlocal mask
        if free:
            room[free].append((times, items))
            mask |= 1 << free
        else:
            full.append((times, items))

    for times, items, free in groups:
        put(times, items, free)
    for length in sorted(left, reverse=True):
        todo = left[length]
        while todo:
            if above := mask >> length:
                free = length + (above & -above).bit_length() - 1
                times, items = room[free].pop()
                if not room[free]:
                    mask &= ~(1 << free)
            else:
                free, items = capacity, ()
                times = -(-todo // (capacity // length))
            each = free // length
            bins = min(times, todo // each)
            if bins:
                put(bins, (*items, (length, each)), free - each * length)
                todo -= bins * each
            if times > bins and todo:
                put(1, (*items, (length, todo)), free - todo * length)
                bins, todo = bins + 1, 0
            if times > bins and items:
                put(times - bins, items, free)
    return [*full, *((t, i) for found in room.values() for t, i in found)]


def _slots(groups: list[tuple], capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, runs of places: first rank, first sequence, copies, first offset."""
    runs = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    sequence = 0
    for times, items in groups:
        offset = 0
        for length, copies in items:
            runs[length].append((taken[length], sequence, copies, offset))
            taken[length] += times * copies
            offset += length * copies
        sequence += times
    return {x: tuple(np.array(v, dtype=np.int64).T) for x, v in runs.items()}


def pack(cut: DataFrame, capacity: int = 4096, rounds: int = 24, group_rows: int = 100_000) -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset``, in as few sequences as the plan reaches.

    Pieces are written once, so that ranks hold when executors are lost. Only the histogram (at
    most ``capacity`` rows) and the plan made from it (bounded by capacity and rounds) pass the
    driver. Pieces of one length are ranked in groups of about ``group_rows``, dealt by a hash,
    so a length that most pieces have is many groups. Equal rows are interchangeable.
    """
    spark = cut.sparkSession
    rows = durable(cut)
    counts = {int(r.length): int(r.n) for r in
              rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    deal = -(-max([1, *counts.values()]) // group_rows)
    plan = spark.sparkContext.broadcast(_slots(plan_bins(counts, capacity, rounds), capacity))
    own = [c for c in rows.columns]
    dealt = rows.withColumn("_deal", F.pmod(F.xxhash64(*own), F.lit(deal)).cast("int"))
    before = (
        dealt.groupBy("length", "_deal").agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_deal"))
                    - F.col("_n")).drop("_n"))
    rank = F.row_number().over(Window.partitionBy("length", "_deal").orderBy(*own))
    ranked = (dealt.withColumn("_row", rank).join(before, ["length", "_deal"])
              .withColumn("_rank", F.col("_before") + F.col("_row") - 1)
              .select(*own, "_rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = plan.value
        for batch in batches:
            length = batch["length"].to_numpy()
            rank = batch["_rank"].to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length).tolist():
                at = np.flatnonzero(length == x)
                first, start, copies, begin = slots[x]
                run = np.searchsorted(first, rank[at], side="right") - 1
                inside = rank[at] - first[run]
                sequence[at] = start[run] + inside // copies[run]
                offset[at] = begin[run] + inside % copies[run] * x
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in own), pa.array(sequence), pa.array(offset)],
                names=[*own, "sequence_id", "offset"])

    more = [T.StructField(name, T.LongType()) for name in ("sequence_id", "offset")]
    return ranked.mapInArrow(place, T.StructType([*rows.schema.fields, *more]))


def pack_documents(
    documents: DataFrame, tokenizer: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
    capacity: int = 4096, rounds: int = 24,
) -> DataFrame:
    """Packs every document, nulls as empty texts; one row per piece: ``keep``, ``piece``,
    ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset``. Repeated rows are
    packed as often as they stand there; further columns are ignored."""
    packed = pack(pieces(documents, tokenizer, text, keep, capacity), capacity, rounds)
    return packed.select(
        *(F.col(f"c{i}").alias(name) for i, name in enumerate(keep)),
        "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
