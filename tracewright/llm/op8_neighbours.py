"""Approximate nearest neighbours by cross-polytope hashing, reranked exactly."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.session import durable


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (a power of two long), scaled to keep norms."""
    x = x.copy()
    n, step = x.shape[1], 1
    while step < n:
        pairs = x.reshape(len(x), -1, 2, step)
        a, b = pairs[:, :, 0].copy(), pairs[:, :, 1].copy()
        pairs[:, :, 0], pairs[:, :, 1] = a + b, a - b
        step *= 2
    return x / np.sqrt(n)


@dataclass(frozen=True)
class Hashing:
    """``tables`` hash tables. A code joins the nearest signed axes of independent
    pseudo-rotations; ``axes`` says how many coordinates each of them looks at."""

    tables: int
    probes: int
    axes: tuple[int, ...]
    seed: int = 11

    @staticmethod
    def for_size(rows: int, dimension: int, tables: int, probes: int, bucket_rows: int) -> Hashing:
        """Enough axes that a bucket keeps about ``bucket_rows`` rows at any input size."""
        whole = 1 << max(0, dimension - 1).bit_length()
        want, axes = max(2, rows // bucket_rows), []
        while want > 1:
            take = min(whole, max(1, want // 2))
            axes.append(1 << (take.bit_length() - 1))
            want //= 2 * axes[-1]
        return Hashing(tables, probes, tuple(axes or [1]))

    @property
    def codes_each(self) -> int:
        """Codes of one table."""
        return prod(2 * axes for axes in self.axes)

    def rotated(self, x: np.ndarray, table: int, part: int) -> np.ndarray:
        whole = max(1 << max(0, x.shape[1] - 1).bit_length(), self.axes[part])
        y = np.zeros((len(x), whole), dtype=np.float32)
        y[:, :x.shape[1]] = x
        random = np.random.default_rng((self.seed, table, part))
        for _ in range(3):
            y = hadamard(y * random.choice(np.float32([-1, 1]), whole))
        return y[:, :self.axes[part]]

    def codes(self, x: np.ndarray, table: int, probes: int = 1) -> np.ndarray:
        """The ``probes`` codes of each row with the least loss, the nearest first.

        The loss of an axis is its squared shortfall against the nearest one. A code's parts add
        up; combinations are kept part by part, best first.
        """
        most = max(1, 2_000_000 // (probes * min(probes, 2 * max(self.axes))))
        if len(x) > most:
            return np.concatenate([self.codes(x[at:at + most], table, probes)
                                   for at in range(0, len(x), most)])
        code = np.zeros((len(x), 1), dtype=np.int64)
        loss = np.zeros((len(x), 1), dtype=np.float32)
        for part, axes in enumerate(self.axes):
            y = self.rotated(x, table, part)
            both = np.concatenate([y, -y], axis=1)
            if probes == 1:
                code = code * (2 * axes) + both.argmax(axis=1)[:, None]
                continue
            short = (both.max(axis=1, keepdims=True) - both) ** 2
            take = min(probes, 2 * axes)
            order = np.argsort(short, axis=1, kind="stable")[:, :take]
            own = np.take_along_axis(short, order, axis=1)
            total = (loss[:, :, None] + own[:, None, :]).reshape(len(x), -1)
            joint = (code[:, :, None] * (2 * axes) + order[:, None, :]).reshape(len(x), -1)
            keep = np.argsort(total, axis=1, kind="stable")[:, :probes]
            code = np.take_along_axis(joint, keep, axis=1)
            loss = np.take_along_axis(total, keep, axis=1)
        return code


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near one: cosines stay as they
    are to the last bit, and no product of very large or small components leaves the doubles."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, initial=0))
    return np.ldexp(x, -exponent[:, None])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Rows with an id and a vector of finite numbers, not all of them zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull()).where(
        ~bad & F.exists(embedding, lambda x: x != 0)).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(embedding).cast("array<double>").alias("embedding"))


def _raised(base: DataFrame, asked: DataFrame, plans: dict[int, Hashing], k: int, target: float,
            sample: int) -> dict[int, Hashing]:
    """``plans`` with the probes doubled until the recall measured here reaches ``target``.

    Of each vector length, up to ``sample`` query classes, chosen by their hash, are compared with
    all classes in Spark; a task keeps the ``k`` nearest it saw of each. The share of these that a
    plan makes candidates is its recall, since candidates are compared exactly. Plans that probe
    all their codes need no measuring.
    """
    sizes = [size for size, plan in plans.items() if plan.probes < plan.codes_each]
    if not sizes:
        return plans
    by_hash = Window.partitionBy(F.size("embedding")).orderBy(F.xxhash64("class_id"), "class_id")
    taken = (
        base.where(F.size("embedding").isin(sizes))
        .join(asked.select("class_id").distinct(), "class_id", "left_semi")
        .withColumn("_n", F.row_number().over(by_hash)).where(F.col("_n") <= sample).collect())
    queries = {}
    for size in sizes:
        own = [r for r in taken if len(r.embedding) == size]
        if own:
            queries[size] = (np.array([r.class_id for r in own]),
                             unit(np.array([r.embedding for r in own])))
    shared = base.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {}
        for batch in batches:
            lengths = batch["embedding"].value_lengths().to_numpy()
            for size, (ids, q) in shared.value.items():
                own = batch.filter(pa.array(lengths == size))
                if not len(own):
                    continue
                x = unit(_matrix(own["embedding"], size))
                near = q @ x.T
                near[ids[:, None] == own["class_id"].to_numpy()[None, :]] = -2  # the query itself
                top = np.argsort(-near, axis=1, kind="stable")[:, :k]
                near, vectors = np.take_along_axis(near, top, axis=1), x[top]
                if size in best:
                    near = np.concatenate([best[size][0], near], axis=1)
                    vectors = np.concatenate([best[size][1], vectors], axis=1)
                    top = np.argsort(-near, axis=1, kind="stable")[:, :k]
                    near = np.take_along_axis(near, top, axis=1)
                    vectors = np.take_along_axis(vectors, top[:, :, None], axis=1)
                best[size] = near, vectors
        for size, (near, vectors) in best.items():
            rows = pa.table({
                "size": pa.array(np.full(near.size, size), pa.int32()),
                "query": pa.array(np.repeat(np.arange(len(near)), near.shape[1]), pa.int32()),
                "score": pa.array(near.ravel().astype(np.float64)),
                "embedding": pa.array(list(vectors.reshape(-1, size)), pa.list_(pa.float32()))})
            yield from rows.filter(pa.array(near.ravel() > -2)).combine_chunks().to_batches()

    order = Window.partitionBy("size", "query").orderBy(F.desc("score"))
    truth = (
        base.mapInArrow(run, "size int, query int, score double, embedding array<float>")
        .withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).collect())
    out = dict(plans)
    for size, (_, q) in queries.items():
        own = [r for r in truth if r.size == size]
        if not own:
            continue
        number = np.array([r.query for r in own])
        near = np.array([r.embedding for r in own], dtype=np.float32)
        plan = plans[size]
        coded = [plan.codes(near, table) for table in range(plan.tables)]
        while plan.probes < plan.codes_each:
            hit = np.zeros(len(own), dtype=bool)
            for table in range(plan.tables):
                hit |= (plan.codes(q, table, plan.probes)[number] == coded[table]).any(axis=1)
            if hit.mean() >= target:
                break
            plan = replace(plan, probes=min(2 * plan.probes, plan.codes_each))
        out[size] = plan
    return out


def nearest(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", every: int = 50,
    k: int = 5, tables: int = 16, probes: int = 12, bucket_rows: int = 100, task_rows: int = 2_000,
    target: float = 0.95, sample: int = 200,
) -> DataFrame:
    """For each row whose id ``every`` divides, its ``k`` nearest other rows by cosine.

    Columns ``query_id, rank, vec_id, score``; ties go to the smaller id. All rows are indexed.
    Equal vectors are one class with its ``k + 1`` smallest ids, enough for any query, so a
    vector that a third of all rows hold is searched once. A bucket above ``task_rows`` is dealt
    to several tasks and its queries go to each. Candidates are compared by the original vectors
    in double precision. Vectors of different length are never compared; null, zero, or
    non-finite vectors and null ids take no part; rows with the query's id aren't its candidates.
    Repeated rows count once, an empty table gives no rows, and further columns are ignored.
    Below ``2 * bucket_rows`` rows every row is a candidate. Buckets are planned for each vector
    length by its own rows, and ``probes`` is what is tried first: it is doubled until ``target`` of
    the true neighbours of ``sample`` queries are candidates, at any number of rows.
    """
    valid = usable(vectors, vec_id, embedding)
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    classes = durable(
        valid.distinct().withColumn("_place", place).where(F.col("_place") <= k + 1)
        .groupBy("embedding").agg(F.min("vec_id").alias("class_id"),
                                  F.sort_array(F.collect_list("vec_id")).alias("members")))
    asked = durable(
        valid.where(F.col("vec_id") % every == 0).distinct()
        .withColumnRenamed("vec_id", "query_id")
        .join(classes.select("class_id", "embedding"), "embedding").select("query_id", "class_id"))
    base = classes.select("class_id", "embedding")
    plans = {r.size: Hashing.for_size(r["count"], r.size, tables, probes, bucket_rows) for r in
             base.groupBy(F.size("embedding").alias("size")).count().collect()}
    plans = _raised(base, asked, plans, k, target, sample)

    def codes(probing: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes = batch["embedding"].value_lengths().to_numpy()
                for size in np.unique(sizes).tolist():
                    own = batch.filter(pa.array(sizes == size))
                    x = unit(_matrix(own["embedding"], size))
                    hashing = plans[size]
                    for table in range(hashing.tables):
                        code = hashing.codes(x, table, hashing.probes if probing else 1)
                        each = code.shape[1]
                        step = max(1, 50_000 // each)
                        for at in range(0, len(x), step):
                            some = code[at:at + step]
                            pick = np.repeat(np.arange(at, at + len(some)), each)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(pick), size), pa.int32()),
                                 pa.array(np.full(len(pick), table), pa.int32()),
                                 pa.array(some.ravel(), pa.int64()),
                                 own["class_id"].take(pa.array(pick)),
                                 own["embedding"].take(pa.array(pick))],
                                names=["size", "tab", "code", "class_id", "embedding"])
        return run

    schema = "size int, tab int, code long, class_id long, embedding array<double>"
    index = base.mapInArrow(codes(False), schema)
    probing = base.join(asked.select("class_id").distinct(), "class_id", "left_semi").mapInArrow(
        codes(True), schema)
    key = ["size", "tab", "code"]
    large = (index.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > task_rows)
             .select(*key, F.ceil(F.col("_n") / task_rows).cast("int").alias("_deals")))
    deals = F.coalesce("_deals", F.lit(1))
    index = index.join(large, key, "left").withColumn(
        "deal", F.pmod(F.xxhash64("class_id"), deals).cast("int")).drop("_deals")
    probing = probing.join(large, key, "left").withColumn(
        "deal", F.explode(F.sequence(F.lit(0), deals - 1))).drop("_deals")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        size = left["size"][0].as_py()
        q, c = (scaled(_matrix(t["embedding"], size)) for t in (left, right))
        qn, cn = np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1)
        ids = right["class_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        c, cn, ids = c[order], cn[order], ids[order]
        take = min(len(ids), k + 1)
        out = []
        for at in range(0, len(q), 256):
            near = (q[at:at + 256] @ c.T) / (qn[at:at + 256, None] * cn)
            best = np.argsort(-near, axis=1, kind="stable")[:, :take]
            own = np.repeat(np.arange(at, at + len(near)), take)
            best = best.ravel()
            exact = (q[own] * c[best]).sum(axis=1) / (qn[own] * cn[best])
            out.append((own, ids[best], exact))
        own = np.concatenate([x[0] for x in out])
        return pa.table({
            "a": left["class_id"].combine_chunks().take(pa.array(own)),
            "b": pa.array(np.concatenate([x[1] for x in out]), pa.int64()),
            "score": pa.array(np.concatenate([x[2] for x in out]), pa.float64())})

    group = [*key, "deal"]
    found = probing.groupBy(*group).cogroup(index.groupBy(*group)).applyInArrow(
        compare, "a long, b long, score double").groupBy("a", "b").agg(F.max("score").alias("score"))

    def first(frame: DataFrame, by: str, least: str, limit: int) -> DataFrame:
        order = Window.partitionBy(by).orderBy(F.desc("score"), least)
        return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)

    near = first(found, "a", "b", k + 1).drop("rank")
    members = classes.select(F.col("class_id").alias("b"), F.explode("members").alias("vec_id"))
    near = first(near.join(members, "b"), "a", "vec_id", k + 1).select("a", "vec_id", "score")
    answers = asked.join(near, asked["class_id"] == near["a"]).where("query_id != vec_id")
    return first(answers, "query_id", "vec_id", k).select("query_id", "rank", "vec_id", "score")
