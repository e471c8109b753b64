"""Exact similarity classes of word-shingle sets: a size-aware heavy-light join."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm import blocks as B
from tracewright.llm.words import GRAM_STEPS, Words, blobs, find_words, grams, mix, whole_grams
from tracewright.session import durable, release

#: Sets link when PERCENT * union <= 100 * intersection.
PERCENT = 80


def least_overlap(a: int, b: int) -> int:
    """Fewest common elements of linked sets of these sizes."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def _sets(words: Words, size: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    at = whole_grams(words, size)
    hashes, owner = grams(words.hashes, size)[at], words.text[at]
    counts, firsts = words.counts(), words.firsts()
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = [mix(grams(words.hashes[firsts[i]:firsts[i + 1]], int(counts[i]))
                     ^ np.uint64(int(counts[i]))) for i in short]
        hashes = np.concatenate([hashes, *whole])
        owner = np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    cuts = np.searchsorted(owner, np.arange(words.texts + 1))
    return [hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _digest(values: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed values."""
    first, second = mix(values), mix(values * GRAM_STEPS[1])
    halves = mix(np.array([first.sum() ^ np.uint64(len(values)), second.sum()], dtype=np.uint64))
    return tuple(halves.view(np.int64).tolist())


def _sketch(values: np.ndarray) -> bytes:
    """How many of a set's shingles have each first byte of the hash, up to 255. The sum of two
    sketches' differences is at most the number of shingles that one set alone has."""
    counts = np.bincount((values >> np.uint64(56)).astype(np.int64), minlength=256)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _texts(
    table: pa.Table, text: str, size: int, limit: int = 1 << 20,
) -> Iterator[tuple[pa.Table, list[np.ndarray]]]:
    for part in B.slices(table, text, limit):
        yield part, _sets(find_words(blobs(part[text]), lower=True), size)


def frequent(documents: DataFrame, text: str, size: int, one_in: int = 16, least: int = 4,
             most: int = 200_000) -> np.ndarray:
    """Shingles that many texts hold, from one text in ``one_in``, chosen by its hash.

    They only order the shingles: prefixes take rare ones first, which keeps lists short.
    Any order gives the same links, so neither the sample nor the bound loses one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in _texts(pa.Table.from_batches([batch]), text, size, 4 << 20):
                key, n = np.unique(B.joined(sets), return_counts=True)
                yield B.ask(0, 16, key, n.astype(np.int64))

    def add(table: pa.Table) -> pa.Table:
        key, inverse = np.unique(B.joined(B.unpack(table["keys"])), return_inverse=True)
        n = np.bincount(inverse, B.joined(B.unpack(table["more"], np.int64), np.int64),
                        minlength=len(key)).astype(np.int64)
        return pa.table({"key": pa.array(key[n >= least].view(np.int64)), "n": n[n >= least]})

    sample = documents.where(F.pmod(F.xxhash64(text), F.lit(one_in)) == 0).select(text)
    found = sample.distinct().mapInArrow(run, B.ASKED).groupBy("part").applyInArrow(
        add, "key long, n long")
    top = found.orderBy(F.desc("n"), "key").limit(most).toArrow()
    order = np.argsort(top["key"].to_numpy().view(np.uint64))
    return np.stack([top["key"].to_numpy().view(np.uint64)[order],
                     top["n"].to_numpy().astype(np.uint64)[order]])


def _ranked(values: np.ndarray, common: np.ndarray) -> np.ndarray:
    """A set in the global order: rare shingles first, then by hash."""
    rank = np.zeros(len(values), dtype=np.uint64)
    if common.shape[1]:
        at = np.minimum(np.searchsorted(common[0], values), common.shape[1] - 1)
        rank = np.where(common[0][at] == values, common[1][at], np.uint64(0))
    return values[np.lexsort((values, rank))]


def boundary(list_rows: float, most: int = 16) -> int:
    """Largest set size that is cheaper to join by its subsets than by inverted lists.

    A set of ``n`` shingles costs as many rows as it has subsets of the sizes its partners ask
    for, or its prefix entries with ``list_rows`` rows each, and the reading of both texts.
    """
    best = 0
    for n in range(1, most + 1):
        subsets = sum(comb(n, least_overlap(n, b)) for b in _partners(n))
        prefix = (n - -(-PERCENT * n // 100) + 1) * (1 + list_rows) + n
        if subsets > 4 * prefix:
            break
        best = n
    return best


def _partners(n: int) -> range:
    return range(-(-PERCENT * n // 100), 100 * n // PERCENT + 1)


#: What a set is in a list: one of two equal sizes, the smaller, or the larger of two sizes.
EQUAL, SMALLER, LARGER = -1, -2, -3


def _subset_keys(values: np.ndarray, light: int) -> tuple[list[int], list[int]]:
    """Keys of subsets of the size a link needs, and what the set is in their lists.

    Two light sets link just when they share a key in which their sizes are the key's two.
    """
    out, part, n = [], [], len(values)
    values = mix(values)
    for partner in _partners(n):
        if partner > light:
            continue
        small, large = min(n, partner), max(n, partner)
        need = least_overlap(n, partner)
        pick = np.array(list(combinations(range(n), need)), dtype=np.int64)
        total = values[pick].sum(axis=1) if need else np.zeros(1, np.uint64)
        out += mix(total ^ mix(np.array([small * 4096 + large], dtype=np.uint64))).tolist()
        part += [EQUAL if n == partner else SMALLER if n < partner else LARGER] * len(pick)
    return out, part


def _list_keys(values: np.ndarray, common: np.ndarray, light: int) -> tuple[bytes, bytes]:
    """A set's list keys, those of subsets first, and what it is in the lists of its subsets."""
    keys, part = _subset_keys(values, light) if len(values) <= light else ([], [])
    keys = np.array(keys, dtype=np.uint64)
    if 100 * len(values) > PERCENT * light:
        prefix = len(values) - -(-PERCENT * len(values) // 100) + 1
        keys = np.concatenate([keys, _ranked(values, common)[:prefix]])
    return keys.tobytes(), np.array(part, dtype=np.int8).tobytes()


def _places(keys: bytes, part: bytes) -> np.ndarray:
    """What a set is in each of its lists: negative in those of subsets, else the key's place."""
    part = np.frombuffer(part, dtype=np.int8).astype(np.int32)
    return np.concatenate([part, np.arange(len(keys) // 8 - len(part), dtype=np.int32)])


def digests(documents: DataFrame, doc_id: str, text: str, size: int, common: np.ndarray,
            light: int) -> DataFrame:
    """``id, txt, n_shingles, hi, lo, sketch, keys, part`` of each row, from one reading of its
    text, whose 64-bit hash is ``txt``; the halves are null for an empty set."""
    shared = documents.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sets in _texts(pa.Table.from_batches([batch]), text, size):
                halves = [_digest(x) if len(x) else (None, None) for x in sets]
                lists = [_list_keys(x, shared.value, light) if len(x) else (b"", b"")
                         for x in sets]
                yield from pa.table({
                    "id": part[doc_id],
                    "txt": part["txt"],
                    "n_shingles": pa.array([len(x) for x in sets], pa.int64()),
                    "hi": pa.array([h[0] for h in halves], pa.int64()),
                    "lo": pa.array([h[1] for h in halves], pa.int64()),
                    "sketch": pa.array([_sketch(x) for x in sets], pa.binary()),
                    "keys": pa.array([k[0] for k in lists], pa.binary()),
                    "part": pa.array([k[1] for k in lists], pa.binary()),
                }).combine_chunks().to_batches()

    kind = dict(documents.dtypes)[doc_id]
    return documents.select(doc_id, text, F.xxhash64(text).alias("txt")).mapInArrow(
        run, f"id {kind}, txt long, n_shingles long, hi long, lo long, sketch binary, keys binary, "
             "part binary")


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 40) -> DataFrame:
    """``node, root`` of each node with an edge; the root is the least node it is connected to.

    Large-star and small-star rounds by DataFrame joins and aggregates, each written to the
    shared folder; a node that all others meet is a group of pre-aggregated minima.
    """
    now = durable(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .where("u != v").distinct())
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where(
            "u != v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        after = durable(small)
        change = after.join(now, ["u", "v"], "left_anti").limit(1).count() + now.join(
            after, ["u", "v"], "left_anti").limit(1).count()
        release(now)
        now = after
        if not change:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots).distinct()


def similar_classes(documents: DataFrame, *columns, **options) -> DataFrame:
    """``classified`` without what tells rows of one id and classes of one name apart."""
    return classified(documents, *columns, **options).drop("txt", "root")


def classified(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5,
    block_bytes: int = 4 << 20, chunk: int = 512,
) -> DataFrame:
    """``doc_id, txt, n_shingles, component_id, root``: texts linked by Jaccard similarity 0.8 or
    more. ``txt`` is the 64-bit hash of the text; ``root`` tells the classes apart, also where ids
    are null or repeated, and is null without words.

    Texts are lower-cased (A-Z), words are runs of other than blanks, a set has the distinct
    shingles of ``shingle`` words, or the whole sequence of a shorter text. Nulls and texts
    without words are linked with nothing. The class id is the least id reached by links.

    Equal sets are one set. Light sets (a bound by cost) meet in equal subsets of the size a link
    needs, which is exact without a check. Others meet in inverted lists over prefixes: of
    shingles in a global order, as many first ones as no two linked sets can both miss. Keys that
    one set alone has are dropped by an exchange between blocks. What is left, a list's sets are
    first compared with one of them, and only sets of a list that are then still in different
    classes are compared with each other, inside tasks that get two chunks of the list; a list
    of near copies costs about its length. All links are counted on the whole sets.

    A null id names no class: such a text's class is the least other id, or null. Rows that share
    an id are told apart by their sets; repeated rows share a class.
    """
    light = boundary(2.0)
    read = durable(digests(documents, doc_id, text, shingle, frequent(documents, text, shingle),
                           light))
    least = F.min(F.struct(F.col("id").isNull(), "id", "txt")).alias("least")
    sets = durable(read.where("hi is not null").groupBy("hi", "lo").agg(
        least, *(F.first(c).alias(c) for c in ("n_shingles", "sketch", "keys", "part"))).select(
        F.struct("least.id", "hi", "lo").alias("rep"), "least.txt", F.col("n_shingles").alias("n"),
        "sketch", "keys", "part"))
    # Equal sets are held once from here on; of the rows stay their names.
    own = durable(read.drop("sketch", "keys", "part"))
    release(read)
    kind = dict(sets.dtypes)["rep"]
    n = B.block_count(sets, "keys", block_bytes)
    dealt = sets.select("rep", "n", "keys", "part", F.pmod(
        F.xxhash64("rep.hi", "rep.lo"), F.lit(n)).cast("int").alias("block"))

    def ask(table: pa.Table) -> pa.Table:
        keys = np.sort(B.joined(B.unpack(table["keys"])))
        stay = np.ones(len(keys), dtype=bool)
        stay[2:] = keys[2:] != keys[:-2]
        return pa.Table.from_batches([B.ask(table["block"][0].as_py(), n, keys[stay])])

    def lists(table: pa.Table, answers: pa.Table) -> pa.Table:
        own_keys = B.unpack(table["keys"])
        keys = B.joined(own_keys)
        live = np.isin(keys, B.joined(B.unpack(answers["keys"])))
        places = [_places(k, p) for k, p in zip(
            table["keys"].to_pylist(), table["part"].to_pylist(), strict=True)]
        owner = np.repeat(np.arange(len(own_keys)), [len(x) for x in own_keys])[live]
        return pa.table({
            "list": pa.array(keys[live].view(np.int64)),
            "rep": table["rep"].take(pa.array(owner)),
            "size": table["n"].take(pa.array(owner)).cast(pa.int32()),
            "place": pa.array(B.joined(places, np.int32)[live], pa.int32())})

    asked = B.by_block(dealt.select("block", "keys"), ask, B.ASKED)
    rows = durable(B.with_answers(dealt, B.shared_keys(asked), lists,
                                  f"list long, rep {kind}, size int, place int"))

    # Light sets: a list with both its sizes is connected, so a star of it is enough.
    by_subset = rows.where("place < 0")
    whole = by_subset.groupBy("list").agg(
        F.min(F.when(F.col("place") != LARGER, F.col("rep"))).alias("b"),
        F.max(F.col("place") != SMALLER).alias("both")).where("b is not null and both")
    star = by_subset.join(whole, "list").where("rep != b").select(
        F.col("rep").alias("a"), "b").distinct()

    heavy = rows.where("place >= 0")
    chief = heavy.groupBy("list").agg(
        F.min(F.struct("rep", "size", "place")).alias("c"), F.count("*").alias("n")).where("n > 1")
    may = _may_link("size", "place", "size_b", "place_b")
    pairs = heavy.join(chief.select("list", F.col("c.rep").alias("b"), F.col("c.size").alias("size_b"),
                                    F.col("c.place").alias("place_b")), "list").where("rep != b")
    pairs = durable(pairs.where(may).select(F.col("rep").alias("a"), "b").distinct())
    source = documents.where(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_txt"), F.col(text).alias("_text"))
    named = sets.select("rep", "txt")
    links = durable(_check(_near(pairs, sets), source, named, shingle).unionByName(star))
    classes = components(links)

    # Sets of one list that are in different classes so far.
    known = heavy.join(classes.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "root", F.coalesce("root", "rep"))
    open_lists = known.groupBy("list").agg(
        F.min("root").alias("x"), F.max("root").alias("y")).where("x != y").select("list")
    left = durable(known.join(open_lists, "list", "left_semi"))
    more = durable(_across(left, sets, chunk).join(pairs, ["a", "b"], "left_anti"))
    further = _check(more, source, named, shingle)
    if further.limit(1).count():
        classes = components(links.unionByName(further))
    named = durable(sets.join(classes.withColumnRenamed("node", "rep"), "rep", "left").select(
        "rep", F.coalesce("root", "rep").alias("root")))
    release(rows, pairs, links, left, more, further)
    named = named.join(named.groupBy("root").agg(F.min("rep.id").alias("class")), "root").select(
        F.col("rep.hi").alias("hi"), F.col("rep.lo").alias("lo"), "class",
        F.struct("root.hi", "root.lo").alias("root"))
    return own.join(named, ["hi", "lo"], "left").select(
        F.col("id").alias(doc_id), "txt", "n_shingles",
        F.coalesce("class", "id").alias("component_id"), "root")


def _may_link(size, place, size_b, place_b):
    """Sizes that can link, and places at which the first common shingle can stand."""
    a, b, i, j = (F.col(x) for x in (size, size_b, place, place_b))
    need = F.ceil(PERCENT * (a + b) / F.lit(100.0 + PERCENT) - F.lit(1e-9))
    return (100 * F.least(a, b) >= PERCENT * F.greatest(a, b)) & (
        F.least(i, j) + F.least(a - i, b - j) >= need)


def _dealt(members: DataFrame, chunk: int) -> tuple[DataFrame, float]:
    """The members, each once for every pair ``i, j`` of chunks of its list that it is ``own`` in,
    and the number of these rows. Two chunks of one class never meet."""
    root = F.struct("root.hi", "root.lo")
    of_root = members.groupBy("list", root.alias("of")).agg(F.count("*").alias("n")).withColumn(
        "alone", F.col("n") > chunk)
    groups = durable(of_root.groupBy(
        "list", F.when(F.col("alone"), F.col("of")).alias("of")).agg(F.sum("n").alias("n")).withColumn(
        "chunks", F.ceil(F.col("n") / F.lit(chunk)).cast("int")))
    chunks = groups.select("list", "of", (F.col("n") / F.col("chunks")).alias("n"), F.explode(
        F.sequence(F.lit(0), F.col("chunks") - 1)).alias("number"))
    chunks = durable(chunks.withColumn("own", F.xxhash64("of", "number")))
    left, right = (chunks.select("list", F.col("of").alias(f"of_{x}"), F.col("n").alias(f"n_{x}"),
                                 F.col("own").alias(x)) for x in "ij")
    meet = durable(left.join(right, "list").where(
        (F.col("i") <= F.col("j")) & (F.col("of_i").isNull() | ~F.col("of_i").eqNullSafe(F.col("of_j"))))
        .select("list", "i", "j", F.when(F.col("i") == F.col("j"), F.col("n_i")).otherwise(
            F.col("n_i") + F.col("n_j")).alias("n")))
    copied = meet.agg(F.sum("n")).first()[0] or 0
    either = meet.select("list", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("own"))
    alone = groups.where("of is not null").select(
        F.col("list").alias("_list"), "of", F.col("chunks").alias("_own"))
    rest = groups.where("of is null").select(F.col("list").alias("_rest"), F.col("chunks").alias("_all"))
    dealt = members.join(alone, (F.col("list") == F.col("_list")) & (root == F.col("of")), "left").join(
        rest, F.col("list") == F.col("_rest"), "left")
    number = F.pmod(F.xxhash64("rep.hi", "rep.lo"), F.coalesce("_own", "_all")).cast("int")
    dealt = dealt.withColumn("own", F.xxhash64("of", number)).join(either, ["list", "own"])
    return dealt, copied


def _across(members: DataFrame, sets: DataFrame, chunk: int, part_rows: int = 20_000) -> DataFrame:
    """``a, b``: sets of one list and of different classes that neither sizes, places nor
    sketches rule out.

    A list is dealt into chunks of about ``chunk`` sets, those of a class with more sets than that
    into chunks of their own. Every two chunks that can hold sets of different classes meet in one
    task; a stranger among near copies thus costs the list's length. A task gets about
    ``part_rows`` rows, counted as they are dealt, or two chunks if these have more.
    """
    dealt, copied = _dealt(members, chunk)
    parts = max(1, int(-(-copied // part_rows)))
    dealt = dealt.join(sets.select("rep", "sketch"), "rep").select(
        F.pmod(F.xxhash64("list", "i", "j"), F.lit(parts)).alias("part"), "list", "i", "j", "own",
        "rep", "size", "place", F.col("root.hi").alias("root_hi"),
        F.col("root.lo").alias("root_lo"), "sketch")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("list", "ascending"), ("i", "ascending"), ("j", "ascending")])
        at, i, j, own, size, place, hi, lo = (table[c].to_numpy() for c in (
            "list", "i", "j", "own", "size", "place", "root_hi", "root_lo"))
        size, place = size.astype(np.int64), place.astype(np.int64)
        sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), dtype=np.uint8).reshape(
            -1, 256).astype(np.int16)
        ends = np.flatnonzero((np.diff(at) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        found = [np.zeros((2, 0), dtype=np.int64)]
        for start, end in zip([0, *ends], [*ends, len(at)], strict=True):
            x = start + np.flatnonzero(own[start:end] == i[start])
            y = x if i[start] == j[start] else start + np.flatnonzero(own[start:end] == j[start])
            for a in x:
                b = y[y > a] if y is x else y
                small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
                need = -(-PERCENT * (small + large) // (100 + PERCENT))
                most = np.minimum(place[a], place[b]) + np.minimum(
                    size[a] - place[a], size[b] - place[b])
                b = b[((hi[a] != hi[b]) | (lo[a] != lo[b])) & (
                    100 * small >= PERCENT * large) & (most >= need)]
                if len(b):
                    alone = np.abs(sketch[a] - sketch[b]).sum(axis=1, dtype=np.int64)
                    b = b[(100 - PERCENT) * (size[a] + size[b]) >= (100 + PERCENT) * alone]
                    found.append(np.stack([np.full(len(b), a), b]))
        first, second = np.concatenate(found, axis=1)
        rep = table["rep"]
        return pa.table({"a": rep.take(pa.array(first)), "b": rep.take(pa.array(second))})

    kind = dict(sets.dtypes)["rep"]
    near = dealt.groupBy("part").applyInArrow(run, f"a {kind}, b {kind}")
    return near.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _packed(rows: DataFrame, text: str, shingle: int) -> DataFrame:
    """Each set as one packed value, from the texts that have its id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sets in _texts(pa.Table.from_batches([batch]), text, shingle):
                named = [(r["hi"], r["lo"]) for r in part["rep"].to_pylist()]
                own = pa.array([len(x) > 0 and _digest(x) == r for x, r in zip(
                    sets, named, strict=True)], pa.bool_())
                yield from pa.table({
                    "rep": part["rep"], "values": pa.array([x.tobytes() for x in sets], pa.binary()),
                }).filter(own).combine_chunks().to_batches()

    kind = dict(rows.dtypes)["rep"]
    return rows.mapInArrow(run, f"rep {kind}, values binary")


def _near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that their sketches do not rule out: sets that share a passage seldom stay."""
    left = sets.select(F.col("rep").alias("a"), F.col("n").alias("m"), F.col("sketch").alias("x"))
    right = sets.select(F.col("rep").alias("b"), "n", F.col("sketch").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch[c].to_pylist()), dtype=np.uint8).reshape(
                -1, 256).astype(np.int32) for c in ("x", "y"))
            alone = np.abs(x - y).sum(axis=1)
            both = batch["m"].to_numpy() + batch["n"].to_numpy()
            yield batch.select(["a", "b"]).filter(
                pa.array((100 - PERCENT) * both >= (100 + PERCENT) * alone))

    kind = dict(sets.dtypes)["rep"]
    return durable(pairs.join(left, "a").join(right, "b").select(
        "a", "b", "m", "n", "x", "y").mapInArrow(run, f"a {kind}, b {kind}"))


def _check(pairs: DataFrame, source: DataFrame, named: DataFrame, shingle: int,
           broadcast_rows: int = 200_000) -> DataFrame:
    """The pairs whose whole sets link. Only texts of the pairs are read on, one row's text for
    each set, which ``named`` gives the hash of; up to ``broadcast_rows`` of them are found by a
    broadcast of id and hash, more by a shuffled join."""
    sought = durable(pairs.select(F.col("a").alias("rep")).unionByName(
        pairs.select(F.col("b").alias("rep"))).distinct().join(named, "rep"))
    few = sought.limit(broadcast_rows + 1).count() <= broadcast_rows
    member = source.join(
        F.broadcast(sought) if few else sought,
        F.col("_id").eqNullSafe(F.col("rep.id")) & (F.col("_txt") == F.col("txt"))).select(
        "rep", "_text")
    packed = durable(_packed(member, "_text", shingle).dropDuplicates(["rep"]))
    left = packed.select(F.col("rep").alias("a"), F.col("values").alias("x"))
    right = packed.select(F.col("rep").alias("b"), F.col("values").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stay = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                stay.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(stay, pa.bool_()))

    kind = dict(packed.dtypes)["rep"]
    linked = durable(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(
        run, f"a {kind}, b {kind}"))
    release(packed, sought)
    return linked
