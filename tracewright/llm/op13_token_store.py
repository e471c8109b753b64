"""Token ids in flat binary files, with keyed access through a minimal perfect hash index.

A store is a folder of three tables. ``payload``: shards of nothing but ids, little-endian, document
behind document, each closed by the end id, in ascending order of the keys. ``keys``: key and
copy of each document, in that order. ``index``: for each bucket of keys a minimal perfect hash
function, and per slot of it a fingerprint of the key and the place of its document. The index holds
no keys; a key that is not there is told by its fingerprint (32 bits).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.llm.tokens import encoder
from tracewright.llm.words import blobs, mix
from tracewright.session import durable, release, shared_folder

_ODD = 0x9E3779B97F4A7C15
PLACES = ("part", "chunk", "offset", "start", "n_tokens")
#: How ids travel until they are sorted.
PACKING = "zstd"
KINDS = ("<i4", "<i4", "<i8", "<i8", "<i8")


# ---- the hash function ------------------------------------------------------------------------


@dataclass
class PerfectHash:
    """Numbers ``n`` different keys (pairs of 64-bit hashes) from 0 to ``n - 1``.

    Levels of bit arrays: a key that is alone in its place of a level sets the bit there; the
    others go on to the next. A key's number is the rank of its bit, from a count before each word.
    Keys left after the last level (equal pairs, in practice none) are kept as a sorted list.
    """

    sizes: np.ndarray   # bits of each level, multiples of 64
    words: np.ndarray   # all levels, 64 bits each
    before: np.ndarray  # set bits before each word
    rest: np.ndarray    # first hashes of what was left, ascending

    @staticmethod
    def place(first: np.ndarray, second: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64(level * _ODD % (1 << 64))
        return (mix(first ^ mix(second + salt)) % np.uint64(size)).astype(np.int64)

    @staticmethod
    def build(first: np.ndarray, second: np.ndarray, gamma: float = 2.0, levels: int = 48):
        sizes, words = [], []
        for level in range(levels):
            if not len(first):
                break
            size = 64 * max(1, -(-int(gamma * len(first)) // 64))
            at = PerfectHash.place(first, second, level, size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, dtype=bool)
            bits[at[alone]] = True
            words.append(np.packbits(bits, bitorder="little").view("<u8"))
            sizes.append(size)
            first, second = first[~alone], second[~alone]
        joined = np.concatenate(words) if words else np.zeros(0, dtype="<u8")
        counts = np.bitwise_count(joined).astype(np.int64)
        return PerfectHash(np.array(sizes, dtype="<i8"), joined,
                           (np.cumsum(counts) - counts).astype("<i8"), np.sort(first))

    def numbers(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Each key's number; any number, or -1, for a key that was not built in."""
        out = np.full(len(first), -1, dtype=np.int64)
        open_ = np.arange(len(first))
        base = 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(open_):
                break
            at = self.place(first[open_], second[open_], level, size)
            word, bit = base + (at >> 6), (at & 63).astype(np.uint64)
            own = self.words[word]
            hit = (own >> bit) & np.uint64(1) == 1
            below = own & ((np.uint64(1) << bit) - np.uint64(1))
            rank = self.before[word] + np.bitwise_count(below)
            out[open_[hit]] = rank[hit]
            open_ = open_[~hit]
            base += size >> 6
        if len(open_) and len(self.rest):
            at = np.searchsorted(self.rest, first[open_])
            found = (at < len(self.rest)) & (
                self.rest[np.minimum(at, len(self.rest) - 1)] == first[open_])
            total = int(np.bitwise_count(self.words).sum())
            out[open_[found]] = total + at[found]
        return out


def _bytes(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    return np.frombuffer(column[0].as_buffer(), dtype=dtype)


def _hashes(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return tuple(table[name].to_numpy().view(np.uint64) for name in ("h1", "h2"))


def hashed(keys: DataFrame, key: str, buckets: int) -> DataFrame:
    """``keys`` (``key`` and ``copy``) with two hashes and the bucket of each."""
    own = (F.col(key).isNull(), F.col(key), F.col("copy"))
    return keys.withColumns({"h1": F.xxhash64(*own), "h2": F.xxhash64(F.lit("second"), *own)}).withColumn(
        "bucket", F.pmod(F.shiftrightunsigned("h1", 7), F.lit(buckets)).cast("int"))


# ---- writing ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class TokenStore:
    """A written store. ``width`` is the bytes of an id; ``end_id`` closes each document."""

    folder: str
    key: str
    width: int
    end_id: int
    buckets: int

    @property
    def kind(self) -> np.dtype:
        return np.dtype(f"<u{self.width}")

    def keys(self, spark: SparkSession) -> DataFrame:
        """``key`` and ``copy`` (0, 1, ... among documents of one key) of all documents."""
        return spark.read.parquet(f"{self.folder}/keys")

    def locate(self, keys: DataFrame) -> DataFrame:
        """``key``, ``copy`` and the place of each distinct wanted document that is there.

        Keys meet their bucket of the index in one shuffle; each is then looked up in constant
        time. A key that is not stored is left out, but for one in 2**32 of them.
        """
        spark = keys.sparkSession
        key_type = keys.schema[self.key].dataType.simpleString()
        wanted = hashed(keys.select(self.key, F.col("copy").cast("long").alias("copy")).distinct(),
                        self.key, self.buckets)
        index = spark.read.parquet(f"{self.folder}/index")

        def look(keys: pa.Table, index: pa.Table) -> pa.Table:
            names = [self.key, "copy", *PLACES]
            if not len(keys) or not len(index):
                none = keys.select([self.key, "copy"]).slice(0, 0)
                for name, kind in zip(PLACES, KINDS, strict=True):
                    none = none.append_column(name, pa.array(np.zeros(0, kind)))
                return none
            function = PerfectHash(
                _bytes(index["sizes"], "<i8"), _bytes(index["words"], "<u8"),
                _bytes(index["before"], "<i8"), _bytes(index["rest"], "<u8"))
            first, second = _hashes(keys)
            number = function.numbers(first, second)
            prints = _bytes(index["prints"], "<u4")
            there = (number >= 0) & (number < len(prints))
            there[there] = prints[number[there]] == (second[there] >> np.uint64(32)).astype(np.uint32)
            number = number[there]
            found = keys.filter(pa.array(there))
            return pa.table(
                [found[self.key], found["copy"],
                 *(pa.array(_bytes(index[name], kind)[number])
                   for name, kind in zip(PLACES, KINDS, strict=True))], names=names)

        schema = (f"`{self.key}` {key_type}, copy long, part int, chunk int, offset long, start long, "
                  "n_tokens long")
        return wanted.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(look, schema)

    def fetch(self, located: DataFrame) -> DataFrame:
        """``located`` with ``ids`` (little-endian 32-bit, with the end id), read from the files.

        Only the shards asked for are read; each travels once to the task that cuts it.
        """
        spark = located.sparkSession
        names = located.columns
        number = [F.regexp_extract("path", rf"/{x}=(\d+)/", 1).cast("int").alias(x)
                  for x in ("part", "chunk")]
        files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option(
            "recursiveFileLookup", "true").load(f"{self.folder}/payload").select(*number, "content")
        files = files.join(located.select("part", "chunk").distinct(), ["part", "chunk"], "left_semi")

        def cut(rows: pa.Table, files: pa.Table) -> pa.Table:
            content = [np.frombuffer(x.as_buffer(), dtype=self.kind) for x in files["content"]]
            if len(rows) and len(content) != 1:
                raise ValueError(f"{len(content)} files of one shard")
            ids = [content[0][a:a + n].astype("<u4").tobytes() for a, n in
                   zip(rows["offset"].to_pylist(), rows["n_tokens"].to_pylist(), strict=True)]
            return rows.select(names).append_column("ids", pa.array(ids, pa.binary()))

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in located.schema.fields)
        return located.groupBy("part", "chunk").cogroup(files.groupBy("part", "chunk")).applyInArrow(
            cut, f"{fields}, ids binary")

    def measured(self, located: DataFrame) -> DataFrame:
        """``located`` with the CRC-32 of each document's ids as the files hold them."""
        return self.fetch(located).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def _encoded(documents: DataFrame, tokenizer: str, key: str, text: str, width: int) -> DataFrame:
    kind = np.dtype(f"<u{width}")
    key_type = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = encoder(tokenizer).encode(blobs(batch["_text"]))
            if len(ids) and int(ids.max()) >> (8 * width):
                raise ValueError(f"ids must fit {width} bytes")
            raw, codec = ids.astype(kind).tobytes(), pa.Codec(PACKING)
            ends = (np.cumsum(counts) * width).tolist()
            packed = [codec.compress(raw[a:b], asbytes=True) for a, b in
                      zip([0, *ends], ends, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch["_key"], pa.array(packed, pa.binary()), pa.array(counts)],
                names=["_key", "packed", "n"])

    return documents.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(
        run, f"_key {key_type}, packed binary, n long")


def _chunked(ordered: DataFrame, key_type: str, width: int, end_id: int, shard_bytes: int,
             shard_documents: int = 50_000) -> DataFrame:
    """Shards of whole documents, as many to each as fit ``shard_bytes`` (one at least) and
    ``shard_documents``.

    Runs along sorted partitions; ``copies`` count equal keys from the partition's first row.
    """
    end = np.array([end_id], dtype=f"<u{width}").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, size, last, copy = 0, 0, 0, None, -1
        payload, keys, copies, offsets, lengths = [], [], [], [], []

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([chunk], pa.int32()),
                pa.array([b"".join(payload)[:-width]], pa.binary()),
                pa.array([size // width], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.array(keys, kind)),
                *(pa.array([x], pa.list_(pa.int64())) for x in (copies, offsets, lengths)),
            ], names=["part", "chunk", "payload", "size", "keys", "copies", "offsets", "lengths"])

        kind = None
        codec = pa.Codec(PACKING)
        for batch in batches:
            kind = batch["_key"].type
            for part_, key, packed, n in zip(*(batch[x].to_pylist() for x in (
                    "part", "_key", "packed", "n")), strict=True):
                part = part_
                ids = codec.decompress(packed, n * width, asbytes=True) if n else b""
                if size and (size + len(ids) + width > shard_bytes or len(keys) >= shard_documents):
                    yield shard()
                    chunk, size = chunk + 1, 0
                    payload, keys, copies, offsets, lengths = [], [], [], [], []
                copy = copy + 1 if copy >= 0 and key == last else 0
                last = key
                payload += (ids, end)
                keys.append(key)
                copies.append(copy)
                offsets.append(size // width)
                lengths.append(len(ids) // width + 1)
                size += len(ids) + width
        if size:
            yield shard()

    return ordered.mapInArrow(
        run, f"part int, chunk int, payload binary, size long, keys array<{key_type}>, copies array<long>, "
             "offsets array<long>, lengths array<long>")


def _places(chunks: DataFrame) -> DataFrame:
    """One row per document: ``_key``, ``copy`` among all of its key, and its place."""
    last_key, last_copy = F.element_at("keys", -1), F.element_at("copies", -1)
    small = chunks.select(
        "part", "chunk", "size", F.get("keys", F.lit(0)).alias("first"), last_key.alias("last"),
        (last_copy + 1).alias("run"))
    # One row per range: bounded by the number of ranges.
    ranges = small.groupBy("part").agg(
        F.sum("size").alias("size"), F.min_by("first", "chunk").alias("first"),
        F.max_by("last", "chunk").alias("last"), F.max_by("run", "chunk").alias("run"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy("last").orderBy("part")
    step = Window.orderBy("part")
    ranges = ranges.withColumn("so_far", F.sum("run").over(same)).select(
        "part", "first", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("begin"),
        F.when(F.lag("last").over(step).eqNullSafe(F.col("first")) & (F.row_number().over(step) > 1),
               F.lag("so_far").over(step)).otherwise(0).alias("carry"))
    inside = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = small.select("part", "chunk", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("base"))
    bases = bases.join(ranges, "part").select(
        "part", "chunk", (F.col("begin") + F.col("base")).alias("base"), "first", "carry")
    rows = chunks.select("part", "chunk", F.explode(F.arrays_zip(
        "keys", "copies", "offsets", "lengths")).alias("d"))
    rows = rows.join(bases, ["part", "chunk"])
    carried = F.when(F.col("d.keys").eqNullSafe(F.col("first")), F.col("carry")).otherwise(0)
    return rows.select(
        F.col("d.keys").alias("_key"), (F.col("d.copies") + carried).alias("copy"), "part", "chunk",
        F.col("d.offsets").alias("offset"), (F.col("base") + F.col("d.offsets")).alias("start"),
        F.col("d.lengths").alias("n_tokens"))


def _indexed(table: pa.Table) -> pa.Table:
    first, second = _hashes(table)
    function = PerfectHash.build(first, second)
    number = function.numbers(first, second)
    if len(number) and len(np.unique(number)) != len(number):
        raise ValueError("two keys of a bucket have equal hashes")
    order = np.argsort(number)
    columns = {
        "sizes": function.sizes, "words": function.words, "before": function.before,
        "rest": function.rest,
        "prints": (second[order] >> np.uint64(32)).astype("<u4"),
        **{name: table[name].to_numpy()[order] for name in PLACES},
    }
    return pa.table({
        "bucket": pa.array([table["bucket"][0].as_py()], pa.int32()),
        **{name: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for name, x in columns.items()}})


def write_store(
    documents: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 2,
    width: int = 2, shard_bytes: int = 16 << 20, range_bytes: int = 64 << 20,
    bucket_keys: int = 20_000,
) -> TokenStore:
    """Encodes all documents and writes them with their index into the shared folder.

    Ascending keys, nulls first; documents of one key stand by a hash of their ids, and each is a
    document of its own (``copy`` 0, 1, ...; ``key`` may be any column not named like those of the
    index). A null text has no ids, so only the end id stands
    for it. Long texts are whole: a document never spans shards, and a shard that holds one is as
    long as it. An empty table gives an empty store. Further columns are ignored. Texts do
    not travel: what is sorted are the ids, in ranges of about ``range_bytes`` by (key, hash, place in
    the written ids), so a key that a third of all rows have is many ranges.
    """
    spark = documents.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/store-{uuid.uuid4().hex}"
    key_type = documents.schema[key].dataType.simpleString()
    ids = durable(_encoded(documents, tokenizer, key, text, width))
    rows, total = ids.agg(F.count("*"), F.sum((F.col("n") + 1) * width)).first()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(total or 0) // range_bytes))
    order: list[Column] = [F.col("_key").asc_nulls_first(), F.col("_hash"), F.col("_row")]
    ordered = (
        ids.withColumns({"_hash": F.xxhash64("packed"), "_row": F.monotonically_increasing_id()})
        .repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("part"), "_key", "packed", "n"))
    chunks = durable(_chunked(ordered, key_type, width, end_id, shard_bytes), "zstd")
    release(ids)
    end = "".join(map(chr, np.array([end_id], dtype=f"<u{width}").tobytes()))
    # The text writer puts bytes down as they are; what ends a line there is the last end id here.
    (chunks.select("part", "chunk", F.col("payload").cast("string"))
     .write.partitionBy("part", "chunk").option("lineSep", end).text(f"{folder}/payload"))
    places = _places(chunks)
    store = TokenStore(folder, key, width, end_id, max(1, -(-rows // bucket_keys)))
    places.select(F.col("_key").alias(key), "copy").write.parquet(f"{folder}/keys")
    built = hashed(places, "_key", store.buckets).select("bucket", "h1", "h2", *PLACES)
    binary = ("sizes", "words", "before", "rest", "prints", *PLACES)
    built.groupBy("bucket").applyInArrow(
        _indexed, "bucket int, " + ", ".join(f"{x} binary" for x in binary)
    ).write.parquet(f"{folder}/index")
    release(chunks)
    return store

