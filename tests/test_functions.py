from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from tracewright.functions.prefix import global_prefix
from tracewright.functions.quantiles import CELL_US, exact_quantiles

PROBS = {"q0": 0.0, "median": 0.5, "p90": 0.9, "p95": 0.95, "q1": 1.0}


def test_quantiles_match_numpy(spark):
    rng = random.Random(3)
    data = [("hot", rng.choice([0, 5, CELL_US * 3 + rng.randrange(CELL_US * 40)]))
            for _ in range(3000)]
    data += [(f"k{i % 7}", rng.randrange(-CELL_US * 5, CELL_US * 5)) for i in range(400)]
    data += [("one", 7), (None, 3), (None, 9)]
    df = spark.createDataFrame(data, "k string, v long").repartition(6)
    for bound in (None, 10):
        out = {r["k"]: r for r in rows(exact_quantiles(df, ["k"], "v", PROBS, max_groups=bound))}
        groups = {k for k, _ in data}
        assert set(out) == groups
        for k in groups:
            values = [v for key, v in data if key == k]
            assert out[k]["n"] == len(values)
            assert int(out[k]["total"]) == sum(values)
            for name, p in PROBS.items():
                assert out[k][name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_weighted_and_global_quantiles(spark):
    df = spark.createDataFrame([(1, 3), (10, 1), (20, 2)], "v long, w long")
    row = rows(exact_quantiles(df, [], "v", {"median": 0.5}, max_groups=1, weight="w"))[0]
    values = [1, 1, 1, 10, 20, 20]
    assert row["median"] == np.quantile(values, 0.5)
    assert (row["n"], int(row["total"])) == (6, sum(values))


def test_prefix_matches_a_sort(spark):
    rng = random.Random(4)
    data = [(rng.choice([1, 1, 1, rng.randrange(50)]), i, rng.randrange(9)) for i in range(2000)]
    df = spark.createDataFrame(data, "k int, id int, v long").repartition(7)
    got = global_prefix(df, [F.col("k").desc(), F.col("id").asc()], ["v"]).orderBy("rank").collect()
    total = 0
    for place, (k, i, v) in enumerate(sorted(data, key=lambda r: (-r[0], r[1])), start=1):
        total += v
        row = got[place - 1]
        assert (row["rank"], row["k"], row["id"], row["cum_v"]) == (place, k, i, total)
    assert {r["total_v"] for r in got} == {total}


def test_selection_by_counting(spark, monkeypatch):
    """The key at every kind of rank, with most rows on one number and texts that are prefixes."""
    from tracewright.functions import selection

    rng = random.Random(2)
    data = [(7, "".join(rng.choices("aäb", k=rng.randrange(6)))) for _ in range(400)]
    data += [(rng.randrange(-10**12, 10**12), str(i)) for i in range(150)]
    df = spark.createDataFrame(data, "n long, t string").repartition(3)
    order = sorted(data, key=lambda r: (r[0], r[1].encode()))
    for few, cells in ((10_000, 4096), (5, 16)):
        monkeypatch.setattr(selection, "FEW_ROWS", few)
        monkeypatch.setattr(selection, "CELLS", cells)
        for rank in (1, 2, 75, 200, 411, 549, 550):
            assert selection.select_key(df, "n", "t", rank) == order[rank - 1]
