"""Hard negatives by exact integer inner products: Strassen tiles and mergeable heaps."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.session import broadcast_if_small, durable

FAN = 64  # heaps that one merge takes in
_LEAST = np.iinfo(np.int64).min


# ---- one tile ---------------------------------------------------------------------------------


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = 32) -> np.ndarray:
    """``a @ b.T`` of int64 matrices by Strassen's seven products, down to ``leaf``.

    An odd side gets a row or column of zeros at its level. Sums wrap at 64 bits, and wrapped sums
    still add up to the right product wherever the product itself fits 64 bits.
    """
    (m, k), n = a.shape, len(b)
    if min(m, k, n) <= leaf:
        return a @ b.T
    if m % 2 or n % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, n % 2), (0, k % 2)))
    m2, k2, n2 = len(a) // 2, a.shape[1] // 2, len(b) // 2
    a11, a12, a21, a22 = a[:m2, :k2], a[:m2, k2:], a[m2:, :k2], a[m2:, k2:]
    # b holds the right factor's columns as rows: its upper right block is the lower left here.
    b11, b21, b12, b22 = b[:n2, :k2], b[:n2, k2:], b[n2:, :k2], b[n2:, k2:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m2, 2 * n2), dtype=np.int64)
    out[:m2, :n2] = p1 + p4 - p5 + p7
    out[:m2, n2:] = p3 + p5
    out[m2:, :n2] = p2 + p4
    out[m2:, n2:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` highest allowed scores of each row (all, if fewer), in no
    order; of equal scores those further left."""
    columns = scores.shape[1]
    if columns <= k:
        return np.nonzero(allowed)
    if np.abs(scores).max(initial=0) < (1 << 62) // columns:
        ranked = scores * columns - np.arange(columns)
        ranked[~allowed] = _LEAST
        taken = np.argpartition(ranked, columns - k, axis=1)[:, columns - k:]
    else:
        taken = np.argsort(np.where(allowed, ~scores, -(_LEAST + 1)), axis=1, kind="stable")[:, :k]
    rows = np.repeat(np.arange(len(scores)), k)
    taken = taken.ravel()
    kept = allowed[rows, taken]
    return rows[kept], taken[kept]


@dataclass
class Heap:
    """The first ``k`` scored ids of each slot: by slot, highest score, smallest id."""

    slot: np.ndarray
    score: np.ndarray
    vec_id: np.ndarray

    @staticmethod
    def of(slot, score, vec_id, k: int) -> Heap:
        order = np.lexsort((vec_id, ~score, slot))
        slot, score, vec_id = slot[order], score[order], vec_id[order]
        kept = np.flatnonzero(Heap.ranks(slot) <= k)
        return Heap(slot[kept], score[kept], vec_id[kept])

    @staticmethod
    def ranks(slot: np.ndarray) -> np.ndarray:
        """Place of each entry in its slot, from 1."""
        new = np.flatnonzero(np.diff(slot, prepend=slot[:1] - 1)) if len(slot) else slot
        return np.arange(len(slot)) - np.repeat(new, np.diff(np.append(new, len(slot)))) + 1

    @staticmethod
    def read(column: pa.ChunkedArray) -> Heap:
        parts = [np.frombuffer(x.as_buffer(), dtype="<i8").reshape(3, -1) for x in column]
        return Heap(*np.concatenate(parts, axis=1)) if parts else Heap(*np.zeros((3, 0), np.int64))

    def raw(self) -> bytes:
        return np.stack([self.slot, self.score, self.vec_id]).astype("<i8").tobytes()


@dataclass
class Block:
    """Rows of one vector length, by id: ids, labels and whole components."""

    ids: np.ndarray
    labels: np.ndarray
    matrix: np.ndarray

    @staticmethod
    def read(table: pa.Table) -> Block:
        ids, labels = (np.frombuffer(table[x][0].as_buffer(), "<i8") for x in ("ids", "labels"))
        matrix = np.frombuffer(table["matrix"][0].as_buffer(), f"<i{table['width'][0].as_py()}")
        return Block(ids, labels, matrix.reshape(len(ids), table["size"][0].as_py()).astype(np.int64))


def _pack(block: str):
    def pack(table: pa.Table) -> pa.Table:
        size = table["size"][0].as_py()
        flat = table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        matrix = np.floor(256 * flat.reshape(len(table), size)).astype(np.int64)
        ids, labels = table["vec_id"].to_numpy(), table["label"].to_numpy()
        order = np.lexsort((*matrix.T[::-1], labels, ids))
        most = int(np.abs(matrix).max(initial=0))
        width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - 1))
        return pa.table({
            "size": pa.array([size], pa.int32()), block: table[block].slice(0, 1),
            "width": pa.array([width], pa.int32()),
            **{name: pa.array([np.ascontiguousarray(x[order]).astype(kind).tobytes()], pa.binary())
               for name, x, kind in (("ids", ids, "<i8"), ("labels", labels, "<i8"),
                                     ("matrix", matrix, f"<i{width}"))}})

    return pack, f"size int, {block} long, width int, ids binary, labels binary, matrix binary"


# ---- all rows ---------------------------------------------------------------------------------


def usable(vectors: DataFrame, vec_id: str, label: str, embedding: str) -> DataFrame:
    """Distinct rows with id, label and a vector of finite numbers whose products are longs."""
    finite = ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= 2.0 ** 23))
    norm = F.aggregate(embedding, F.lit(0.0), lambda s, x: s + F.pow(F.lit(256.0) * x, F.lit(2.0)))
    whole = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        F.col(embedding).cast("array<double>").alias("embedding"))
    embedding = "embedding"
    return whole.where("vec_id is not null and label is not null and embedding is not null").where(
        finite).where(norm < 2.0 ** 61).distinct()


def _merged(heaps: DataFrame, blocks: int, k: int) -> DataFrame:
    """One heap for each block of anchors, from at most ``FAN`` heaps at a time."""

    def merge(table: pa.Table) -> pa.Table:
        heap = Heap.read(table["heap"])
        heap = Heap.of(heap.slot, heap.score, heap.vec_id, k)
        return pa.table({**{x: table[x].slice(0, 1) for x in ("size", "ablock", "cblock")},
                         "heap": pa.array([heap.raw()], pa.binary())})

    while True:
        heaps = heaps.withColumn("cblock", F.floor(F.col("cblock") / FAN)).groupBy(
            "size", "ablock", "cblock").applyInArrow(
            merge, "size int, ablock long, cblock long, heap binary")
        blocks = -(-blocks // FAN)
        if blocks <= 1:
            return heaps.drop("cblock")


def hard_negatives(
    vectors: DataFrame, vec_id: str = "vec_id", label: str = "label", embedding: str = "embedding",
    every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    block_rows: int = 2048, anchor_rows: int = 1024,
) -> DataFrame:
    """For each anchor (a row whose id ``every`` divides) and each of its ``positives`` best rows of
    the same label, the ``negatives`` best rows of other labels whose score lies between ``low`` and
    ``high`` percent of the positive's: ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``.

    A score is the exact inner product of the components times 256, rounded down; higher first,
    ties to the smaller id. Null ids, labels and vectors, and vectors with a null or non-finite
    component take no part, nor do vectors so long that a score might not be a long (squared
    length of the whole components from 2**61 on). Repeated rows count once; rows that share an id but
    differ are rows of their own, and a row with the anchor's id is never its candidate. Vectors of
    different length do not meet. An empty table, and anchors without positives or without
    scores inside the window, give no rows. Further columns are ignored.

    Anchors and candidates are packed into blocks, dealt by a hash of the whole row, so that no label
    or vector can fill one. Every tile of two blocks is one task's work; the products are
    computed twice, first for the positives, then for the windows they set.
    """
    rows = usable(vectors, vec_id, label, embedding).withColumn("size", F.size("embedding"))
    rows = durable(rows)
    sizes = durable(rows.groupBy("size").agg(
        F.ceil(F.count("*") / block_rows).alias("cblocks"),
        F.ceil(F.count_if(F.col("vec_id") % every == 0) / anchor_rows).alias("ablocks"),
    ).where("ablocks > 0"))
    found = sizes.agg(F.count("*"), F.max("cblocks")).first()
    blocks = found[1] or 1
    rows = rows.join(broadcast_if_small(sizes, found[0]), "size")
    own = ("vec_id", "label", "embedding")
    pack, schema = _pack("cblock")
    candidates = rows.withColumn("cblock", F.pmod(F.xxhash64(*own), F.col("cblocks"))).groupBy(
        "size", "cblock").applyInArrow(pack, schema)
    pack, schema = _pack("ablock")
    anchors = rows.where(F.col("vec_id") % every == 0).withColumn(
        "ablock", F.pmod(F.xxhash64(F.lit("anchor"), *own), F.col("ablocks"))).groupBy(
        "size", "ablock").applyInArrow(pack, schema)
    candidates, anchors = durable(candidates), durable(anchors)
    tile = ["size", "ablock", "cblock"]

    def dealt(frame: DataFrame, over: str, count: str) -> DataFrame:
        counts = broadcast_if_small(sizes.select("size", count), found[0])
        return frame.join(counts, "size").withColumn(
            over, F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))).drop(count)

    across = dealt(candidates, "ablock", "ablocks")

    def heaps(anchors: DataFrame, slots) -> DataFrame:
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not len(left) or not len(right):
                return left.select(tile).slice(0, 0).append_column("heap", pa.array([], pa.binary()))
            a, c = Block.read(left), Block.read(right)
            heap = slots(left, a, c, strassen(a.matrix, c.matrix))
            return pa.table({**{x: left[x].slice(0, 1) for x in tile},
                             "heap": pa.array([heap.raw()], pa.binary())})

        left = dealt(anchors, "cblock", "cblocks")
        return left.groupBy(*tile).cogroup(across.groupBy(*tile)).applyInArrow(
            run, "size int, ablock long, cblock long, heap binary")

    def of_label(_, a: Block, c: Block, scores: np.ndarray) -> Heap:
        same = (a.labels[:, None] == c.labels) & (a.ids[:, None] != c.ids)
        row, column = best(scores, same, positives)
        return Heap.of(row, scores[row, column], c.ids[column], positives)

    def in_window(left: pa.Table, a: Block, c: Block, scores: np.ndarray) -> Heap:
        own = Heap.read(left["positives"])
        place = Heap.ranks(own.slot) - 1
        other = a.labels[:, None] != c.labels
        slots, found, ids = [], [], []
        for k in range(positives):
            pick = place == k
            anchor, score = own.slot[pick], own.score[pick]
            whole, part = np.divmod(score, 100)  # no product of a score by a percentage overflows
            least = low * whole - (-low * part) // 100
            most = high * whole + high * part // 100
            near = scores[anchor]
            allowed = other[anchor] & (near >= least[:, None]) & (near <= most[:, None])
            row, column = best(near, allowed, negatives)
            slots.append(anchor[row] * positives + k)
            found.append(near[row, column])
            ids.append(c.ids[column])
        return Heap.of(*(np.concatenate(x) for x in (slots, found, ids)), negatives)

    best_of_label = _merged(heaps(anchors, of_label), blocks, positives)
    asking = durable(anchors.join(
        best_of_label.withColumnRenamed("heap", "positives"), ["size", "ablock"]))
    windows = _merged(heaps(asking, in_window), blocks, negatives)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

    def rows_of(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({x: pa.array([], pa.int32() if x == "rank" else pa.int64()) for x in names})
        ids = np.frombuffer(left["ids"][0].as_buffer(), "<i8")
        own, heap = Heap.read(left["positives"]), Heap.read(right["heap"])
        slot = own.slot * positives + Heap.ranks(own.slot) - 1
        at = np.searchsorted(slot, heap.slot)
        return pa.table([
            pa.array(ids[own.slot[at]]), pa.array(own.vec_id[at]),
            pa.array(Heap.ranks(heap.slot), pa.int32()), pa.array(heap.vec_id),
            pa.array(own.score[at]), pa.array(heap.score)], names=list(names))

    block = ["size", "ablock"]
    return asking.groupBy(*block).cogroup(windows.groupBy(*block)).applyInArrow(
        rows_of, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
                 "negative_score long")
