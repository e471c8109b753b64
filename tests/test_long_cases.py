"""The segmented plan for long cases gives what the plain plan gives."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import SF, rows
from test_conformance import brute_distance
from tracewright.log import ProcessLog
from tracewright.operators import conformance, contracts, discovery, performance, prediction

IDEAL = ("a", "b", "c", "d")


@pytest.fixture(scope="module")
def skewed(spark):
    """One case with a third of all events, a second long case, and many short ones."""
    rng = random.Random(11)
    data = []
    for case, size in [("hot", 900), ("warm", 300)] + [(f"c{i}", 4 + i % 9) for i in range(180)]:
        clock = 0
        for i in range(size):
            clock += rng.choice([0, 0, 1, 60])  # many equal timestamps
            data.append((case, i, rng.choice("abcdx"), clock, float(i % 7), i % 3 == 0))
    frame = spark.createDataFrame(
        data, "case_id string, event_index int, activity string, t long, "
        "processing_minutes double, automated boolean",
    )
    return frame.withColumn("timestamp", F.timestamp_seconds("t")).repartition(5).cache()


@pytest.fixture(scope="module")
def plain(skewed):
    return ProcessLog(skewed)


@pytest.fixture(scope="module")
def segmented(skewed):
    return ProcessLog(skewed, case_limit=100, segment_rows=150)


def as_set(df):
    return Counter(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def test_lanes(plain, segmented):
    assert not plain.has_long_cases
    assert segmented.has_long_cases
    assert segmented.regular.select("case_id").distinct().count() == 180
    hot = segmented.segments.where("case_id = 'hot'")
    assert hot.select("segment").distinct().count() > 3
    assert sorted(r.position for r in hot.collect()) == list(range(1, 901))


def test_transitions(plain, segmented):
    assert as_set(discovery.transitions(segmented)) == as_set(discovery.transitions(plain))


def test_edges_and_bottlenecks(plain, segmented):
    for build in (discovery.directly_follows, performance.bottlenecks):
        assert as_set(build(segmented)) == as_set(build(plain))


def test_numbered(plain, segmented):
    columns = ("case_id", "event_index")
    assert as_set(segmented.numbered(*columns)) == as_set(plain.numbered(*columns))


@pytest.mark.parametrize("label_steps", [5, 400, 1_000])
def test_variants(plain, segmented, skewed, monkeypatch, label_steps):
    """The same rows under any case limit, with labels that spell out all steps or only some."""
    monkeypatch.setattr(discovery, "LABEL_STEPS", label_steps)
    wide = ProcessLog(skewed, case_limit=3, segment_rows=150)
    for build in (discovery.case_sequences, discovery.case_variants, discovery.variants,
                  discovery.variant_steps):
        whole = as_set(build(plain))
        assert as_set(build(segmented)) == whole
        assert as_set(build(wide)) == whole
    traces = {r.case_id: r.steps for r in discovery.trace_arrays(plain).collect()}
    labels = {r.case_id: r.variant for r in discovery.case_variants(segmented).collect()}
    for case, steps in traces.items():
        assert labels[case].startswith(" > ".join(steps[:label_steps]))
        assert (f"... [{len(steps)} steps, " in labels[case]) == (len(steps) > label_steps)
    found = {}
    for r in discovery.variant_steps(segmented).collect():
        found.setdefault(r.variant, {})[r.position] = r.activity
    for case, steps in traces.items():
        assert [found[labels[case]][i + 1] for i in range(len(steps))] == steps


def test_equal_long_traces_are_one_variant(spark, skewed):
    hot = skewed.where("case_id = 'hot'")
    twin = hot.withColumn("case_id", F.lit("twin"))
    swapped = hot.withColumn("case_id", F.lit("swap")).withColumn(
        "activity", F.when(F.col("event_index") == 450, "q").otherwise(F.col("activity"))
    )
    log = ProcessLog(hot.unionByName(twin).unionByName(swapped), case_limit=100, segment_rows=150)
    counts = sorted(r["case_count"] for r in rows(discovery.variant_counts(log)))
    assert counts == [1, 2]


def test_conformance(plain, segmented, monkeypatch):
    monkeypatch.setattr(conformance, "PIECE_EVENTS", 40)
    monkeypatch.setattr(conformance, "FOLD_PIECES", 4)
    expected = conformance.conformance_arrays(plain, IDEAL)
    assert as_set(conformance.conformance_arrays(segmented, IDEAL)) == as_set(expected)
    trace = discovery.trace_arrays(plain).where("case_id = 'warm'").first()["steps"]
    found = expected.where("case_id = 'warm'").first()["edit_distance"]
    assert found == brute_distance(trace, list(IDEAL))


def test_early_cut(plain, segmented, skewed):
    cases = skewed.groupBy("case_id").agg(
        F.min("timestamp").alias("created_at"), F.lit(1.0).alias("cycle_time_hours")
    )
    built = [as_set(prediction.sla_features(log, cases, "x", "a", "b")) for log in (plain, segmented)]
    assert built[0] == built[1]


def test_regressions(monkeypatch, skewed):
    shuffled = skewed.withColumn(
        "timestamp", F.timestamp_seconds((F.col("event_index") * 7919) % 101)
    )
    expected = as_set(contracts.timestamp_regressions(shuffled))
    import tracewright.operators.contracts as module

    monkeypatch.setattr(
        module, "ProcessLog",
        lambda events, order: ProcessLog(events, order, case_limit=100, segment_rows=150),
    )
    assert as_set(contracts.timestamp_regressions(shuffled)) == expected
    assert sum(expected.values()) > 100


# A query for each operator that works on a log.
ON_LOGS = (
    "variants", "variant_steps", "case_sequences", "dfg", "activity_summary", "conformance_cases",
    "bottlenecks", "case_explorer", "case_timeline", "segment_sla", "breach_transitions",
    "sla_features_clicks", "whatif_observed", "kpis", "trace_distances", "counter_increase",
    "dq_ts_regression", "variants_orders", "deviations_orders", "sla_features",
)


@pytest.mark.parametrize("name", ON_LOGS)
def test_queries_do_not_depend_on_the_case_limit(spark, monkeypatch, name):
    from helpers import SF
    from tracewright.plans import queries

    monkeypatch.setattr(queries, "_made", {})
    plain = as_set(queries.registry()[name](spark, SF))
    order = ProcessLog.__init__.__defaults__[0]
    monkeypatch.setattr(ProcessLog.__init__, "__defaults__", (order, 3, 200))
    monkeypatch.setattr(queries, "_made", {})
    assert as_set(queries.registry()[name](spark, SF)) == plain
    assert sum(plain.values()) > 0


def test_dealt_logs_give_the_same_rows(spark, monkeypatch):
    """Parts by the number of events, whatever the session's partitions are, and the same rows."""
    from tracewright import log as module
    from tracewright.sources import adapters

    events = adapters.order_process_events(spark, SF)
    cases = adapters.order_process_cases(spark, SF)
    whole, dealt = (ProcessLog(events, adapters.ORDER_SORT) for _ in range(2))
    parts = -(-dealt.facts.events // 700)
    assert parts > 4
    for made in (
        discovery.transitions, discovery.case_sequences, discovery.trace_arrays,
        lambda log: prediction.sla_features(
            log, cases, adapters.ORDER_DECISION, adapters.ORDER_APPROVAL, adapters.ORDER_REWORK),
    ):
        first = made(whole)
        with monkeypatch.context() as patch:
            patch.setattr(module, "TASK_ROWS", 700)
            second = made(dealt)
        assert first.columns == second.columns
        assert first.exceptAll(second).count() == second.exceptAll(first).count() == 0
        plan = second._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(case_id" in plan and f", {parts})" in plan
