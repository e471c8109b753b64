"""Repeats, decontamination, Jaccard classes and language model against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tracewright.llm import (
    op1_substrings,
    op2_decontamination,
    op5_jaccard,
    op7_language_model,
    queries,
)

SF = "/root/testdata/sf0.001"
BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(params=["edges", "table"])
def documents(request, spark, corpus):
    return corpus if request.param == "edges" else spark.read.parquet(f"{SF}/documents.parquet")


def test_cover_meets_every_difference():
    for period in (1, 2, 7, 13, 21, 26):
        cover = op1_substrings.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("window,period", [(35, 21), (5, 3), (4, 1)])
def test_repeats(documents, window, period):
    result = op1_substrings.digest(op1_substrings.remove_repeats(
        documents, window=window, period=period, block_bytes=20_000))
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in result.collect())
    rows = pairs(documents)
    wanted = op1_substrings.brute_force([t for _, t in rows], window)
    assert got == Counter((i, *w) for (i, _), w in zip(rows, wanted, strict=True))


def brute_hits(documents, items, window=10):
    found = defaultdict(set)
    for item, text in items:
        words = WORD.findall(low(text))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            found[tuple(words[i:i + n])].add("" if item is None else str(item))
    out = Counter()
    for doc, text in documents:
        words, hit, names = WORD.findall(low(text)), set(), set()
        for n in {len(x) for x in found}:
            for i in range(len(words) - n + 1):
                if own := found.get(tuple(words[i:i + n])):
                    hit.update(range(i, i + n))
                    names |= own
        out[(doc, len(words), len(hit), len(names),
             hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit))] += 1
    return out


@pytest.mark.parametrize("broadcast_rows", [300_000, 0])
def test_decontamination(spark, documents, broadcast_rows):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(70, " ".join(f"P{i}!" for i in range(20, 40))), (71, "one"), (72, None), (73, "?"),
              (74, "e F"), (None, "u17 u18 u19"), (70, "w w w w w w w w w w w")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    result = op2_decontamination.digest(op2_decontamination.contaminated(
        documents, benchmark, broadcast_rows=broadcast_rows))
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                  for r in result.collect())
    assert got == brute_hits(pairs(documents), items)


def test_decontamination_has_no_python(spark):
    plan = queries.op2_decontaminate(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_decontamination_cuts_texts_once(spark):
    docs = spark.createDataFrame(
        [(1, "x A b C d y"), (1, "x A b C d y"), (2, None), (None, "Ä1 b-c \u00d7 [?]"), (3, "a b"), (3, "a")],
        "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, "a B c D"), (8, "a")], "item_id long, text string")
    result = op2_decontamination.contaminated(docs, benchmark)
    assert "regexp" not in result._jdf.queryExecution().toString().lower()
    got = Counter((r.doc_id, r.n_words, r.n_hit, *r["items"]) for r in result.collect())
    assert got == {(1, 6, 4, "7", "8"): 2, (2, 0, 0): 1, (None, 4, 0): 1, (3, 2, 1, "8"): 1,
                   (3, 1, 1, "8"): 1}


def test_decontamination_fingerprints_have_no_python(spark):
    rows = spark.createDataFrame([(1, 2, ["a", "b", "c"])], "doc long, txt long, words array<string>")
    prints = spark.createDataFrame([(5, True)], "print long, known boolean")
    met = op2_decontamination._met(rows, prints, 3, 2, [1])
    assert not re.search("EvalPython|Pandas|MapInArrow", met._jdf.queryExecution().toString())
    assert [(r.entry.start, r.entry.size) for r in met.collect()] == [(3, 0)]


def brute_classes(documents):
    sets = [(i, (lambda w: {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set())(
        BLANK_WORD.findall(low(t)))) for i, t in documents]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(sets):
        for b, (j, y) in enumerate(sets[:a]):
            both = len(x & y)
            if x and y and 100 * both >= 80 * (len(x) + len(y) - both):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for a, (i, _) in enumerate(sets):
        if i is not None:
            least[find(a)].append(i)
    return Counter((i, len(x), min(least[find(a)], default=None))
                   for a, (i, x) in enumerate(sets))


def made_copies(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(30):
        base = [rng.choice("abcdefgh") for _ in range(rng.choice([3, 6, 8, 10, 12, 15, 18, 30, 70]))]
        for _ in range(6):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                k = rng.randrange(len(words))
                words[k:k + 1] = rng.choice([[], ["z"], [words[k], "q"]])
            out.append(" ".join(words))
    return [(i * 7 % 997, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_of_made_copies(spark, seed):
    rows = made_copies(seed)
    result = op5_jaccard.similar_classes(
        spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=2000, chunk=2)
    assert Counter(tuple(r) for r in result.collect()) == brute_classes(rows)


def test_classes(documents):
    result = op5_jaccard.similar_classes(documents, block_bytes=50_000)
    assert Counter(tuple(r) for r in result.collect()) == brute_classes(pairs(documents))


def test_a_stranger_among_copies_costs_the_length_of_the_list(spark):
    schema = ("list long, rep struct<id:long,hi:long,lo:long>, size int, place int, "
              "root struct<id:long,hi:long,lo:long>")
    rows = [(1, (i, i, i), 20, 0, (0, 0, 0) if i < 600 else (i, i, i)) for i in range(603)]
    members = spark.createDataFrame(rows, schema)
    sets = members.select("rep", F.lit(bytes(256)).alias("sketch"))
    dealt, copied = op5_jaccard._dealt(members, 10)
    assert dealt.count() == round(copied) <= 2 * 603  # all against all in chunks: 603 * 61
    got = {(r.a.id, r.b.id) for r in op5_jaccard._across(members, sets, 10, 100).collect()}
    assert got == {(a, b) for a in range(600, 603) for b in range(a)}


def test_light_sets_meet_by_subsets():
    assert 5 <= op5_jaccard.boundary(2.0) <= 16


def test_language_model(documents):
    rows = documents.withColumn("_train", F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True)))
    tree = op7_language_model.fit_tree(rows.where("_train"))
    got = op7_language_model.score(rows, "_train", tree, keep=("doc_id", "text"), block_bytes=50_000)
    counts = Counter()
    for doc, text in pairs(documents):
        if doc is None or doc % 3:
            counts.update([*BLANK_WORD.findall(low(text)), "\n"])
    total = sum(counts.values())
    assert tree.words + tree.texts == total
    for r in got.collect():
        tokens = [*BLANK_WORD.findall(low(r.text)), "\n"]
        base = sum(math.log10((counts[w] + .5) / (total + .5 * (len(counts) + 1))) for w in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (
            len(tokens), sum(counts[w] > 0 for w in tokens), total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        stream, _ = op7_language_model.spelled([(r.text or "").encode()], tree.depth)
        state, spelt, score, k = 0, 0.0, 0.0, 0
        for place, byte in enumerate(stream.tolist()):
            if place >= tree.depth:
                spelt += float(tree.cost[state, tree.symbol[byte]])
                if byte in (10, 32):
                    share = tree.word_share * counts[tokens[k]] / total
                    score += math.log10(share + (1 - tree.word_share) * 10 ** spelt)
                    spelt, k = 0.0, k + 1
            state = int(tree.follow[state, tree.symbol[byte]])
        assert r.score == pytest.approx(score, rel=1e-4, abs=1e-3)


def test_next_byte_shares_sum_to_one(spark):
    tree = op7_language_model.fit_tree(spark.read.parquet(f"{SF}/documents.parquet"))
    unseen = 256 - int((tree.symbol > 0).sum())
    shares = 10.0 ** tree.cost
    assert (shares[:, 1:].sum(axis=1) + unseen * shares[:, 0]) == pytest.approx(1, abs=1e-4)


@pytest.mark.parametrize("run", [
    lambda d: op1_substrings.remove_repeats(d), lambda d: op5_jaccard.similar_classes(d),
    lambda d: op7_language_model.score(
        d.withColumn("t", F.lit(True)), "t", op7_language_model.fit_tree(d)),
])
def test_empty_table(corpus, run):
    assert run(corpus.limit(0)).collect() == []
