"""Hard negatives and the source audit against brute force and DuckDB."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import check
from tracewright.llm import op11_hard_negatives, op12_divergence, queries
from tracewright.llm.op11_hard_negatives import strassen

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("shape", [(1, 1, 1), (0, 3, 2), (5, 0, 4), (33, 65, 47), (128, 64, 200), (70, 1, 70)])
def test_strassen(shape):
    m, k, n = shape
    rng = np.random.default_rng(m)
    a, b = rng.integers(-1000, 1000, (m, k)), rng.integers(-1000, 1000, (n, k))
    for leaf in (1, 8, 32):
        assert (strassen(a, b, leaf) == a @ b.T).all()
    big = rng.integers(-2**29, 2**29, (m, k)), rng.integers(-2**29, 2**29, (n, k))
    assert (strassen(*big, 4) == big[0] @ big[1].T).all()


def brute_negatives(rows, every, low=30, high=90):
    found = {}
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        found[vec_id, label, tuple(vector)] = [math.floor(256 * x) for x in vector]
    if not found:
        return []
    out = []
    for (anchor, label, a), x in found.items():
        if anchor % every:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y, strict=True)), i, c) for (i, c, b), y in found.items()
                  if i != anchor and len(b) == len(a)]
        for score, positive, _ in sorted(s for s in scored if s[2] == label)[:5]:
            inside = sorted((s, i) for s, i, c in scored if c != label
                            and low * -score <= 100 * -s <= high * -score)
            out += [(anchor, positive, rank, i, -score, -s)
                    for rank, (s, i) in enumerate(inside[:10], start=1)]
    return out


def test_negatives_edge_cases(spark):
    rng = np.random.default_rng(3)
    nan, inf = float("nan"), float("inf")
    rows = [(i, int(rng.integers(0, 3)), [float(x) for x in rng.normal(size=4)]) for i in range(300)]
    rows += [(i, 1, [0.5, -0.25, 0.125, 1.0]) for i in range(300, 420)]  # ties
    rows += [(7, 1, rows[7][2])] * 3 + [(20, 2, [1.0, 1.0, 1.0, 1.0]), (21, 0, [1.0, 1.0, 1.0, 1.0])]
    rows += [(430, None, [1.0] * 4), (None, 1, [1.0] * 4), (440, 1, None), (450, 1, [1.0, None, 0.0, 0.0]),
             (460, 1, [nan, 0.0, 0.0, 0.0]), (470, 1, [inf, 0.0, 0.0, 0.0]), (480, 1, [])]
    rows += [(500 + i, i % 2, [float(x) for x in rng.normal(size=3)]) for i in range(60)]
    rows += [(-10, 1, [1e5, -1e5, 3e4, 2.0]), (-20, 0, [1e5, 1e5, 1e5, -7.0])]
    vectors = spark.createDataFrame(
        [(*r, "x", 1) for r in rows],
        "vec_id long, label int, embedding array<double>, size string, cblock int").repartition(5)
    for sizes in ({}, {"block_rows": 1, "anchor_rows": 7}):
        mined = op11_hard_negatives.hard_negatives(vectors, every=10, **sizes)
        assert sorted(map(tuple, mined.collect())) == sorted(brute_negatives(rows, 10))
    assert op11_hard_negatives.hard_negatives(vectors.limit(0)).collect() == []
    assert op11_hard_negatives.hard_negatives(vectors.where("vec_id = 10")).collect() == []


def test_scores_near_the_limit(spark):
    """Scores whose ranks within a tile don't fit 64 bits beside them."""
    rng = np.random.default_rng(9)
    rows = [(i, i % 2, [float(x) for x in rng.integers(-2**22, 2**22, 2)]) for i in range(60)]
    vectors = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    mined = op11_hard_negatives.hard_negatives(vectors, every=10).collect()
    small = [r for r in rows if sum((256 * x) ** 2 for x in r[2]) < 2.0 ** 61]
    assert len(small) > 30
    assert sorted(map(tuple, mined)) == sorted(brute_negatives(small, 10))


def brute_audit(rows, least, top):
    rows = [tuple(x or "" for x in r) for r in rows]  # lang, source, text
    groups, counts, docs = set(), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        groups.add((lang, source))
        found = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub(
            "[A-Z]", lambda m: m[0].lower(), text))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in {x for x, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        names = [s for x, s in groups if x == lang]
        own = {s: {t: counts[lang, s][t] for t in kept} for s in names}
        own[None] = {t: sum(own[s][t] for s in names) for t in kept}
        p = {s: {t: 1 + 10**9 * (n + 2) // (sum(c.values()) + 2 * len(kept)) for t, n in c.items()}
             for s, c in own.items()}
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in names:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in names if o != s)
            terms = sorted((-f(p[s][t], p[None][t]), t.encode(), t) for t in kept
                           if own[s][t] and p[s][t] > p[None][t])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item, -v, i) for i, (v, _, item) in enumerate(found, start=1)]
    return out


def texts(seed, n):
    rng = np.random.default_rng(seed)
    words = ["the", "The", "über", "don't", "x1y", "日本", "É", "é", "_a_b", "zeta", "mu", "q" * 300]
    for i in range(n):
        size = int(rng.integers(0, 30))
        own = rng.choice(words, size, p=np.array([12, 6, 5, 4, 4, 3, 3, 3, 2, 2, 1, 1]) / 46)
        text = " ".join(own.tolist()) if i % 9 else "the same zeta line"
        yield (["en", "de", None][i % 3 if i % 4 else 0], ["a", "b", "", None, "ü", "Z"][i % 6 if i % 5 else 0],
               None if i % 17 == 0 else text)


@pytest.mark.parametrize("least", [1, 10, 60, 10_000])
def test_audit(spark, monkeypatch, least):
    rows = list(texts(1, 400)) + [("fr", "only", "mot mot"), ("it", "a", ""), ("it", "b", None)]
    documents = spark.createDataFrame(
        [(*r, 1, "k", 2) for r in rows],
        "lang string, source string, text string, part int, term string, n int").repartition(6)
    wanted = sorted(map(str, brute_audit(rows, least, 10)))
    for fan, size in ((128, 8 << 20), (3, 400)):  # the second takes three rounds of the exchange
        monkeypatch.setattr(op12_divergence, "FAN", fan)
        found = op12_divergence.audit(documents, least=least, block_bytes=size).collect()
        assert sorted(str(tuple(r)) for r in found) == wanted
    assert op12_divergence.audit(documents.limit(0)).collect() == []


def test_audit_of_a_long_text(spark):
    long = "Alpha beta, beta; γάμμα 1 " * 300_000
    rows = [("en", "a", long), ("en", "b", "beta γάμμα"), ("en", "c", long), ("en", "c", "alpha")]
    documents = spark.createDataFrame(rows, "lang string, source string, text string")
    found = op12_divergence.audit(documents, least=2).collect()
    assert sorted(str(tuple(r)) for r in found) == sorted(map(str, brute_audit(rows, 2, 10)))


@pytest.mark.parametrize("name", ["op11_mine_negatives", "op12_source_divergence"])
def test_queries_agree_with_sql(spark, name):
    con = duckdb.connect()
    for table in check.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries.registry()[name](spark, SF)
    result = con.execute(queries.oracle_queries()[name])
    names = [d[0] for d in result.description]
    mine = check.canonical([tuple(r) for r in df.collect()], df.columns)
    assert len(mine[0]) > 10
    assert mine == check.canonical(result.fetchall(), names)
