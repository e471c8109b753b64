"""Packing, toxicity, token files, neighbours, personal data, chat windows and the pipeline."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tracewright.llm import (
    op2_decontamination,
    op3_packing,
    op4_toxicity,
    op6_token_counts,
    op8_neighbours,
    op9_pii,
    op10_chat,
    queries,
    tokens,
)

tokenizers = pytest.importorskip("tokenizers")
SF = "/root/testdata/sf0.001"


def ids_of(text):
    tokenizer = tokenizers.Tokenizer.from_file(queries.tokenizer_path())
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("counts", [
    {}, {4096: 3}, {3000: 1000, 1100: 300}, {1: 100_000}, {1366: 10_000, 2: 5}, {2049: 7},
    {x: 3 for x in range(1, 400)},
])
def test_bins_hold_the_histogram(counts):
    held, bins = Counter(), 0
    for times, items in op3_packing.plan_bins(counts):
        assert times > 0 and sum(x * c for x, c in items) <= 4096
        bins += times
        for x, c in items:
            held[x] += c * times
    assert held == Counter(counts)
    assert bins >= -(-sum(x * n for x, n in counts.items()) // 4096)


def test_packing(spark, corpus):
    for documents, capacity in ((corpus, 64), (spark.read.parquet(f"{SF}/documents.parquet"), 4096)):
        rows = op3_packing.pack_documents(
            documents, queries.tokenizer_path(), capacity=capacity).collect()
        wanted = Counter()
        for r in documents.collect():
            ids = np.array([*ids_of(r.text), 1], dtype="<u4")
            for number, at in enumerate(range(0, len(ids), capacity)):
                own = ids[at:at + capacity]
                wanted[(r.doc_id, number, at, len(own), zlib.crc32(own.tobytes()))] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
        bins = defaultdict(list)
        for r in rows:
            bins[r.sequence_id].append((r.offset, r.length))
        for held in bins.values():
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(bins) <= 1.02 * sum(r.length for r in rows) / capacity + 1
    assert op3_packing.pack_documents(corpus.limit(0), queries.tokenizer_path()).collect() == []


def test_toxicity_learns_words_and_prefixes():
    rng = np.random.default_rng(1)
    clean = [f"{a}{b}" for a in ("ba", "ko", "ri", "su") for b in ("ner", "tal", "mis", "dor", "ven")]
    texts, labels = [], []
    for i in range(1500):
        words = rng.choice(clean, rng.integers(5, 60)).tolist()
        if i % 5 == 0:
            words[rng.integers(len(words))] = "grobian" + rng.choice(["en", "s", "er", "chen"])
        texts.append(" ".join(words).encode())
        labels.append(float(i % 5 == 0))
    model = op4_toxicity.train(texts[:1000], np.array(labels[:1000]), ["de"] * 1000)
    scores, truth = model.scores(texts[1000:]), np.array(labels[1000:])
    assert ((scores >= 0.7) == (truth == 1)).mean() > 0.98
    assert model.scores([b"grobianhaft " + b"baner " * 3000])[0] > 0.5
    assert 0 <= model.scores([b""])[0] < 0.7
    assert 0.3 <= model.threshold("de") <= 0.95 and model.threshold(None) == 0.7


def test_toxicity_rows(spark, corpus):
    labels = spark.createDataFrame([(5, 1), (6, 0), (7, 0), (9, None)], "doc_id long, toxic int")
    model = op4_toxicity.fit(corpus, labels)
    rows = op4_toxicity.score(corpus, model).collect()
    assert len(rows) == corpus.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.block for r in rows} == {"k"}
    assert op4_toxicity.score(corpus.limit(0), op4_toxicity.fit(corpus.limit(0), labels)).count() == 0


def test_token_files(spark, corpus, tmp_path):
    documents = corpus
    folder = op6_token_counts.write_token_files(documents, queries.tokenizer_path())
    got = Counter(r.n_tokens for r in op6_token_counts.token_counts(
        spark, folder, block_tokens=100).collect())
    assert got == Counter(len(ids_of(r.text)) for r in documents.collect())
    rng, wanted = np.random.default_rng(0), set()
    for size in (0, 1, 5, 1000):
        ids = rng.choice([0, 1, 256, 257, 2], size=size).astype("<u2")
        ids.tofile(tmp_path / f"f{size}.bin")
        start, number = 0, 0
        for end in np.flatnonzero(ids == 1).tolist():
            wanted.add((f"f{size}.bin", number, start, end - start, True))
            start, number = end + 1, number + 1
        if start < size:
            wanted.add((f"f{size}.bin", number, start, size - start, False))
    rows = op6_token_counts.token_counts(spark, str(tmp_path), end_id=1, block_tokens=7).collect()
    assert {(r.file.rsplit("/")[-1], *r[1:]) for r in rows} == wanted and len(rows) == len(wanted)


def test_token_files_are_read_once(spark, tmp_path):
    np.array([5, 6, 0, 7, 0, 0, 8], dtype="<u2").tofile(tmp_path / "f.bin")
    rows = op6_token_counts.token_counts(spark, str(tmp_path), block_tokens=2)
    assert Counter(r[1:] for r in rows.collect()) == Counter(
        [(0, 0, 2, True), (1, 3, 1, True), (2, 5, 0, True), (3, 6, 1, False)])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_token_files_bound_what_an_encoder_keeps():
    path, most = queries.tokenizer_path(), op6_token_counts.PIECES
    assert tokens.encoder(path, most).most == most <= 250_000
    few, texts = tokens.Encoder(path, 40), [f"w{i} same words x{i}y".encode() for i in range(50)]
    ids, counts = few.encode(texts, block=60)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [
        ids_of(x.decode()) for x in texts]
    assert len(few.place) <= 40


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(600)]
    rows += [(1000 + i, [1.0] * 16) for i in range(120)] + [(1000, [1.0] * 16)]
    rows += [(2000, None), (2050, [0.0] * 16), (2100, [float("nan")] * 16), (2150, [1.0, None]),
             (2200, [1.0, 2.0]), (2201, [2.0, 1.0]), (None, [1.0] * 16)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in
           op8_neighbours.nearest(vectors, bucket_rows=100, task_rows=20).collect()}
    valid = [(r.vec_id, r.embedding) for r in op8_neighbours.usable(
        vectors, "vec_id", "embedding").distinct().collect()]
    exact = total = 0
    for size in (16, 2):
        own = sorted(x for x in valid if len(x[1]) == size)
        ids, x = np.array([v for v, _ in own]), np.array([e for _, e in own])
        for i in np.flatnonzero(ids % 50 == 0):
            cosine = (x * x[i]).sum(1) / (np.linalg.norm(x, axis=1) * np.linalg.norm(x[i]))
            order = [j for j in np.lexsort((ids, -np.round(cosine, 12))) if j != i][:5]
            for rank, j in enumerate(order, 1):
                total += 1
                found = got.get((ids[i], rank))
                exact += found is not None and found[0] == ids[j] and abs(found[1] - cosine[j]) < 1e-9
            total_rows = [k for k in got if k[0] == ids[i]]
            assert len(total_rows) == min(5, len(own) - 1)
    assert exact >= 0.9 * total
    assert op8_neighbours.nearest(vectors.limit(0)).collect() == []


def test_neighbours_of_very_small_and_large_doubles(spark):
    """Norms that under- or overflow: cosines are those of the same vectors at an ordinary length."""
    rng = np.random.default_rng(8)
    plain = rng.normal(size=(40, 6))
    powers = rng.choice([2.0**-700, 2.0**-1000, 1.0, 2.0**800, 2.0**1010], size=40)
    rows = [(10 * i, (x * p).tolist()) for i, (x, p) in enumerate(zip(plain, powers, strict=True))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in op8_neighbours.nearest(vectors).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for i in range(0, 40, 5):
        cosine = plain @ plain[i] / (np.linalg.norm(plain, axis=1) * np.linalg.norm(plain[i]))
        order = [j for j in np.argsort(-cosine) if j != i][:5]
        found = sorted(got[10 * i])
        assert [v for _, v, _ in found] == [10 * j for j in order]
        assert np.allclose([s for _, _, s in found], cosine[order], rtol=1e-12)


def test_neighbours_found_when_few_rows_are_candidates(spark):
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(400, 24))[rng.integers(400, size=8000)] + rng.normal(size=(8000, 24)))
    vectors = spark.createDataFrame(
        [(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    # 256 codes in each of 3 tables, of which 2 are probed at first: about one row in 43.
    got = defaultdict(set)
    for r in op8_neighbours.nearest(vectors, tables=3, probes=2, bucket_rows=16).collect():
        got[r.query_id].add(r.vec_id)
    own = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = total = 0
    for i in range(0, 8000, 50):
        near = own @ own[i]
        near[i] = -2
        best = np.argsort(-near)[:5].tolist()
        found, total = found + len(got[i] & set(best)), total + 5
    assert found >= 0.9 * total


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def real(kind, match):
    digits = re.sub("[^0-9]", "", match)
    luhn = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4)
               for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0
    return {"email": True, "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15,
            "ip": kind == "ip" and all(int(x) <= 255 for x in match.split("."))}[kind]


def base_spans(text):
    return sorted((m.start(), i, k, m.end()) for i, (k, p) in enumerate(BASE.items())
                  for m in re.finditer(p, text or "") if real(k, m.group()))


def test_personal_data(spark, corpus):
    texts = ["é a@b.c_x@d.e@f.g 1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.0004 0000000000255.1.1.1",
             "4111 1111-1111 1111 +1 (222) 333-4444x +12 +1-2", "1" * 20_000, "a" * 20_000,
             "+1 " * 500 + "9", "4111111111111111 " * 50, "a@b.c" * 20,
             "😀 +49 30 1234567, 10.0.0.256 10.0.0.25", "9" * 16 + " " + "0" * 12]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, texts[0])],
                                 "doc_id long, text string")
    rows = corpus.select("doc_id", "text").unionByName(rows)
    got = op9_pii.digest(op9_pii.find_pii(rows)).collect()
    wanted = Counter()
    for doc, text in ((r.doc_id, r.text) for r in rows.collect()):
        spans = base_spans(text)
        listed = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        wanted[(doc, *(sum(s[2] == k for s in spans) for k in BASE),
                hashlib.sha256(listed.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256)
                   for r in got) == wanted
    assert op9_pii.find_pii(rows.limit(0)).collect() == []


def test_whole_parts_of_an_address_are_checked(spark):
    texts = ["10001.2.3.4", "v 1.0.20240115.3", "70100.1.1.1", "1.2.3.10000", "0.0.0.0 1.2.3.256",
             "000.00255.0.000000 x 00256.0.0.0", "9" * 400 + "0012.1.1.1", "4294967297.1.1.1"]
    got = op9_pii.digest(op9_pii.find_pii(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string"))).collect()
    for r in got:
        spans = base_spans(texts[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        assert r.n_ip == sum(k == "ip" for _, _, k, _ in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
    assert sum(r.n_ip for r in got) == 2


def test_redaction_replaces_every_base_span(corpus):
    after = {(r.doc_id, r.text) for r in op9_pii.redact(corpus).collect()}
    assert (11, "ÄÖ é don't <|endoftext|> 日本 mail [EMAIL] or [PHONE].") in after
    assert len(op9_pii.redact(corpus).columns) == len(corpus.columns)
    for _, text in after:
        assert not base_spans(text)


def test_chat_windows(spark):
    mark = r"\### Assistant: </turn> ok"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in
            spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    rows += [(-7, 0, "user", mark), (-7, 1, "assistant", mark), (-8, 0, "assistant", None),
             (None, None, None, None), (-9, 1, "a:b\n~#\\", "x"), (-9, 1, "a:b\n~#\\", "x"),
             (-9, 0, "system", "s " * 3000)]
    rows += [(-10, i, "assistant" if i % 2 else "user", "w " * (i % 700) + "é\\<</turn></turn>#")
             for i in range(200)] + [(-11, 0, "system", "be kind")]
    rows += [(-11, i, "assistant", f"say {i} " * 20) for i in range(1, 60)]
    turns = spark.createDataFrame(
        [(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, window int")
    windows = op10_chat.format_windows(turns, budget=200, history=60)
    got = {r.conv_id: r for r in op10_chat.read_back(windows).collect()}
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        conversations[conv].append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(conversations)
    for conv, turns_of in conversations.items():
        turns_of.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns_of)
        targets = "".join(t for _, r, t in turns_of if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (
            len(turns_of), hashlib.sha256(said.encode()).hexdigest(), len(targets),
            hashlib.sha256(targets.encode()).hexdigest())
    own = [r for r in windows.where("conv_id = -11").orderBy("window").collect()]
    assert len(own) > 3 and all(r.tokens <= 200 for r in own)
    for r in own[1:]:
        first, second = op10_chat.read_window(r.formatted)[:2]
        assert first[:3] == (True, "system", "be kind") and second[0]
    assert op10_chat.read_back(op10_chat.format_windows(turns.limit(0))).collect() == []


def test_pipeline_stages(spark, tmp_path):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs, seen = documents, [documents.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == documents.columns
        seen.append(docs.count())
    assert seen[0] > seen[2] > seen[3] == seen[4] > 0.5 * seen[0]
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert op2_decontamination.contaminated(docs, benchmark).where("contaminated").count() == 0
    assert not any(base_spans(r.text) for r in docs.collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_pipeline_takes_empty_and_odd_rows(spark, corpus):
    odd = corpus.select("doc_id", "text", "lang", "source", F.col("n_chars"))
    for documents in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, documents, SF).collect()


def test_pipeline_tells_rows_apart_by_id_and_text(spark):
    base = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcdefg"}
    near = base["a"] + " more"
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy(F.desc(F.length("text"))).first().text
    rows = [(3, base["a"]), (7, near), (7, base["b"]), (8, base["b"] + " more"),  # two texts of 7
            (None, base["c"]), (5, base["c"] + " more"), (None, base["d"]), (None, ""), (None, ""),
            (None, None), (None, base["e"]), (None, base["e"] + " more"), (9, base["f"]),
            (9, base["f"]), (9, base["g"]), (None, passage), (9, passage + " end")]
    documents = spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in rows],
                                      "doc_id long, text string, lang string, source string, n_chars long")
    kept = Counter((r.doc_id, r.text) for r in
                   corpus_pipeline.near_copies(spark, documents, SF).collect())
    one = [x for x in kept if x[0] is None and (x[1] or "").startswith("e0 ")]
    assert len(one) == 1 and kept.pop(one[0]) == 1
    copied = [x for x in kept if passage in (x[1] or "")]
    assert len(copied) in (1, 2)
    for x in copied:
        assert kept.pop(x) == 1
    assert kept == Counter([(3, base["a"]), (7, base["b"]), (5, base["c"] + " more"), (None, base["d"]),
                            (None, ""), (None, ""), (None, None), (9, base["f"]), (9, base["g"])])
    clean = Counter((r.doc_id, r.text) for r in
                    corpus_pipeline.decontaminate(spark, documents, SF).collect())
    assert clean == Counter(rows[:-2])


def test_pii_learns_from_every_candidate(spark, monkeypatch):
    """Both the trees and the thresholds see all candidates, more than the 20,000 of old."""
    rows = spark.range(0, 26_000, 1, 4).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("host "), F.when(F.col("id") % 2 == 0, "10.2.3.4").otherwise("10.2.3.444")).alias("text"))
    found = op9_pii.candidates(rows, "doc_id", "text")
    everyone = found.where("form = 'base'").count()
    assert everyone > 20_000
    seen, fits = [], op9_pii._fits
    monkeypatch.setattr(op9_pii, "_fits", lambda df: (seen.append(df), fits(df))[1])
    model = op9_pii.fit(found, rounds=1)
    assert model.trees is not None and model.thresholds
    assert sum(df.agg(F.sum("n")).first()[0] for df in seen) == everyone
    assert sum(df.count() for df in seen) < 100
