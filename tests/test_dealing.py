"""Joins by case in tasks whose size follows the rows."""

from __future__ import annotations

from collections import Counter

import pytest

from helpers import SF
from tracewright import ProcessLog
from tracewright.functions import dealing
from tracewright.functions.dealing import cut_by
from tracewright.operators import discovery
from tracewright.sources import adapters


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_pieces_join_like_the_tables(spark, how):
    left = spark.createDataFrame(
        [(f"k{i % 90}", i) for i in range(300)] + [("hot", i) for i in range(400)]
        + [(None, i) for i in range(200)] + [("k1", 7)] * 2, "key string, a int")
    right = spark.createDataFrame(
        [(f"k{i}", i) for i in range(100)] + [("hot", 1), ("hot", 2), ("k2", 5), (None, 9)],
        "key string, b int")
    pieces = cut_by("key", left, right, task_rows=40)(left, right)
    assert len(pieces) == 2  # "hot" and null fill more than a task's rows
    (even, even_right), (heavy, _) = pieces
    assert even.where("key = 'hot' OR key IS NULL").count() == 0
    assert heavy.where("key = 'hot'").count() == 400
    assert "REPARTITION_BY_NUM" in plan_of(even) and "REPARTITION_BY_NUM" not in plan_of(heavy)
    found = even.join(even_right, "key", how).unionByName(heavy.join(pieces[1][1], "key", how))
    assert sorted_rows(found) == sorted_rows(left.join(right, "key", how))
    assert plan_of(even.join(even_right.hint("merge"), "key")).count("Exchange") == 2
    assert cut_by("key", left, right)(left, right) == [(left, right)]


def test_order_log_is_the_same_in_many_parts(spark, monkeypatch):
    whole = adapters.order_process_events(spark, SF)
    assert "REPARTITION_BY_NUM" not in plan_of(whole)
    monkeypatch.setattr(dealing, "TASK_ROWS", 500)
    dealt = adapters.order_process_events(spark, SF)
    assert "REPARTITION_BY_NUM" in plan_of(dealt)
    assert dealt.columns == whole.columns
    assert Counter(map(tuple, dealt.collect())) == Counter(map(tuple, whole.collect()))
    edges = [sorted_rows(discovery.directly_follows(ProcessLog(x, adapters.ORDER_SORT)))
             for x in (whole, dealt)]
    assert edges[0] == edges[1]
