"""Token ids of blocks, and the token store with its perfect hash index."""

from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracewright.llm import blocks, op13_token_store, queries
from tracewright.llm.op13_token_store import PerfectHash
from tracewright.llm.tokens import BLOCK, Encoder

tokenizers = pytest.importorskip("tokenizers")
SF = "/root/testdata/sf0.001"

ODD = [
    "don't l'eau 'start ''s it's", "İstanbul ÀÉÎ × ÷ a×b", "é café ﬁ", "日本語 한국어 가",
    "a b　c\u0085d", "<|endoftext|>x<|startoftext|> <|", "x<|endoftext|>y z", "\x00\x01 a\x1cb \x7f",
    "ab12cd3.4,5;;--x_y", "", "   ", "ŉ ǅ ǰ ȿ ɀ Ʌ", "ß ẞ ſ K Å", "a" * 5000, "</w> w</w>",
    "a\r\nb\tc\x0bd\x0ce", "é" * 3000 + "!" * 3000, "µ º ª ¼ ²", "🙂🙂 a🙂b", "á̧b ̀a",
]


def one_by_one(text):
    tokenizer = tokenizers.Tokenizer.from_file(queries.tokenizer_path())
    return lambda x: tokenizer.encode(x, add_special_tokens=False).ids


def test_blocks_give_the_ids_of_the_tokenizer():
    draw = random.Random(5)
    letters = list("abAB'12 .,<|>\né×İ日́ s t")
    texts = ODD + ["".join(draw.choices(letters, k=draw.randrange(60))) for _ in range(2000)]
    plain = one_by_one(None)
    for block, most in ((8, 1_000_000), (4 << 20, 1_000_000), (300, 40)):
        ids, counts = Encoder(queries.tokenizer_path(), most).encode([x.encode() for x in texts], block)
        ends = np.cumsum(counts)
        for text, end, n in zip(texts, ends, counts, strict=True):
            assert ids[end - n:end].tolist() == plain(text), text[:80]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_blocks_agree_on_whole_tables(spark, sf):
    texts = [r.text or "" for r in
             spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("text").collect()]
    plain = one_by_one(None)
    ids, counts = Encoder(queries.tokenizer_path()).encode([x.encode() for x in texts])
    assert ids.tolist() == [i for x in texts for i in plain(x)]
    assert counts.tolist() == [len(plain(x)) for x in texts]


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = tokenizers.Tokenizer.from_file(path)
    texts = ["Hello  world", "", "don't"]
    ids, counts = Encoder(path).encode([x.encode() for x in texts])
    wanted = [tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
    assert ids.tolist() == sum(wanted, []) and counts.tolist() == [len(x) for x in wanted]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    first, second = (rng.integers(0, 2**64, n, dtype=np.uint64) for _ in range(2))
    first[n // 2:] = first[:n - n // 2]  # half of the keys share their first hash
    function = PerfectHash.build(first, second)
    assert sorted(function.numbers(first, second).tolist()) == list(range(n))
    assert 64 * len(function.words) <= 8 * n + 64 * 20


def test_equal_hashes_are_kept_aside():
    key = np.array([7, 7, 9], dtype=np.uint64)
    function = PerfectHash.build(key, key)
    assert len(function.rest) == 2
    assert function.numbers(key, key)[2] == 0


def expected(rows, end_id=2):
    """(key, start, n, crc) of documents in ascending order, nulls first; ids of one key as a
    sorted multiset, since any order among them is right."""
    plain, start, out = one_by_one(None), 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*plain(text or ""), end_id], dtype="<u4")
        out.append((key, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out, start


def check(spark, documents, **sizes):
    store = op13_token_store.write_store(documents, queries.tokenizer_path(), **sizes)
    rows = store.measured(store.locate(store.keys(spark))).collect()
    wanted, total = expected([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()])
    assert sorted(map(str, wanted)) == sorted(str((r.doc_id, r.n_tokens, r.ids_crc32)) for r in rows)
    rows.sort(key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert at == total
    order = [(r.doc_id is not None, r.doc_id, r.copy) for r in rows]
    assert order == sorted(order, key=lambda x: (x[0], x[1] or 0, x[2]))
    seen = {}
    for r in rows:
        assert r.copy == seen.get(r.doc_id, 0)
        seen[r.doc_id] = r.copy + 1
    return store, rows


def test_store_edge_cases(spark, corpus):
    for sizes in ({}, {"shard_bytes": 100, "range_bytes": 500, "bucket_keys": 3}):
        store, _ = check(spark, corpus, **sizes)
    missing = spark.createDataFrame([(10_000 + i, 0) for i in range(500)] + [(5, 7), (6, 0)], "doc_id long, copy long")
    assert [(r.doc_id, r.copy) for r in store.locate(missing).collect()] == [(6, 0)]
    twice = store.locate(missing.unionByName(missing).where("doc_id = 6"))
    assert twice.count() == 1
    empty = op13_token_store.write_store(corpus.limit(0), queries.tokenizer_path())
    assert empty.measured(empty.locate(empty.keys(spark))).collect() == []
    assert empty.measured(empty.locate(missing)).collect() == []


def test_store_of_a_hot_key(spark):
    """A third of the rows have one id, and another third have none; they fill many ranges."""
    documents = spark.range(0, 3000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 77).when(F.col("id") % 3 == 1, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 5 == 0, None).otherwise(
            F.concat(F.lit("text number "), (F.col("id") % 7).cast("string"))).alias("text"))
    _, rows = check(spark, documents, shard_bytes=400, range_bytes=1000, bucket_keys=100)
    assert len({r.part for r in rows if r.doc_id == 77}) > 2


def test_store_query(spark):
    rows = queries.op13_token_store_ids(spark, SF).collect()
    documents = spark.read.parquet(f"{SF}/documents.parquet").collect()
    wanted, at = {}, 0
    plain = one_by_one(None)
    for r in sorted(documents, key=lambda r: r.doc_id):
        ids = np.array([*plain(r.text or ""), 2], dtype="<u4")
        wanted[r.doc_id] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == wanted


def test_long_document(spark):
    """A text of several megabytes is one document of one shard."""
    long = "word, другой don't été 12 " * 200_000
    documents = spark.createDataFrame([(2, long), (1, "a"), (3, None)], "doc_id long, text string")
    check(spark, documents, shard_bytes=1000)


def test_work_on_a_batch_takes_little_memory(monkeypatch):
    """Blocks, not the batch, bound the encoder's arrays; no text is copied to learn its size; and free
    memory goes back to the system once, when a batch is done."""
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(2000)]
    texts = [" ".join(draw.choices(words, k=300)) for _ in range(2000)]
    raw, encoder = [x.encode() for x in texts], Encoder(queries.tokenizer_path())
    encoder.encode(raw)  # its pieces are known from here on
    table, trimmed = pa.table({"text": [*texts, None, ""]}), []
    monkeypatch.setattr(blocks, "trim", lambda: trimmed.append(1))
    tracemalloc.start()
    try:
        encoder.encode(raw, BLOCK)
        assert tracemalloc.get_traced_memory()[1] < 40e6  # 59 MB in blocks of 2 MB
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        parts = [part.num_rows for part in blocks.slices(table, "text", 1 << 20)]
        assert tracemalloc.get_traced_memory()[1] - before < 1e6
    finally:
        tracemalloc.stop()
    assert sum(parts) == 2002 and len(parts) == 5 and trimmed == [1]
    assert list(blocks.slices(table.slice(0, 0), "text", 100)) == []


def test_trim_gives_memory_back():
    def held():
        with open("/proc/self/status", encoding="utf-8") as file:
            return next(int(x.split()[1]) for x in file if x.startswith("RssAnon")) >> 10

    arrays = [np.ones(60_000, dtype=np.uint8) for _ in range(2000)]
    last = arrays[-1]  # what stands behind the free ones keeps them in the process
    full = held()
    del arrays
    blocks.trim()
    assert held() < full - 80 and last.sum() == 60_000
