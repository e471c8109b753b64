from __future__ import annotations

import pytest

from helpers import rows
from tracewright.operators import discovery, performance


def test_sequences_and_variants(small_log):
    traces = {r["case_id"]: r["steps"] for r in rows(discovery.trace_arrays(small_log))}
    assert traces["K-7"] == ["Intake", "Inspect", "Pack", "Ship"]
    assert traces["K-8"] == ["Intake", "Ship"]
    table = sorted(rows(discovery.variants(small_log)), key=lambda r: r["variant_rank"])
    assert [r["variant_rank"] for r in table] == [1, 2, 3]
    assert {r["variant"]: r["case_count"] for r in table} == {
        "Intake > Inspect > Pack > Ship": 1, "Intake > Ship": 1,
        "Intake > Inspect > Inspect > Inspect > Ship": 1}
    assert [r["cumulative_share"] for r in table] == pytest.approx([1 / 3, 2 / 3, 1])


def test_edges(small_log):
    edges = {(r["source"], r["target"]): r for r in rows(discovery.directly_follows(small_log))}
    first = edges["Intake", "Inspect"]  # waits of one and two hours
    assert first["transition_count"] == 2
    assert first["mean_wait_hours"] == pytest.approx(1.5)
    assert first["median_wait_hours"] == pytest.approx(1.5)
    assert first["p90_wait_hours"] == pytest.approx(1.9)
    again = edges["Inspect", "Inspect"]
    assert again["transition_count"] == 2
    assert again["mean_wait_hours"] == pytest.approx(1.5)
    assert edges["Intake", "Ship"]["p90_wait_hours"] == pytest.approx(10)
    assert edges["Pack", "Ship"]["case_coverage"] == pytest.approx(1 / 3)


def test_activity_summary(small_log):
    table = {r["activity"]: r for r in rows(discovery.activity_summary(small_log))}
    assert {a: r["event_count"] for a, r in table.items()} == {
        "Intake": 3, "Inspect": 4, "Pack": 1, "Ship": 3}
    assert [table[a]["automation_rate"] for a in ("Ship", "Pack")] == [1, 0]
    assert table["Inspect"]["case_coverage"] == pytest.approx(2 / 3)
    assert table["Inspect"]["median_processing_minutes"] == 30


def test_waits_and_bottlenecks(small_log):
    assert discovery.transition_waits(small_log).count() == 8
    table = rows(performance.bottlenecks(small_log))
    assert max(r["bottleneck_score"] for r in table) <= 1
    assert all(0 <= r["case_coverage"] <= 1 for r in table)


def test_zero_waits_give_no_score(spark, small_events):
    from pyspark.sql import functions as F
    from tracewright.log import ProcessLog

    flat = small_events.withColumn("timestamp", F.lit("2026-01-01").cast("timestamp"))
    assert {r["bottleneck_score"] for r in rows(performance.bottlenecks(ProcessLog(flat)))} == {None}


def test_case_performance(small_events):
    table = {r["case_id"]: r for r in rows(performance.case_performance(small_events))}
    assert {c: r["cycle_time_hours"] for c, r in table.items()} == {"K-7": 6, "K-8": 10, "K-9": 10}
    assert {c: r["rework_event_count"] for c, r in table.items()} == {"K-7": 0, "K-8": 0, "K-9": 2}
    assert table["K-8"]["automation_rate"] == pytest.approx(1 / 2)
    assert table["K-7"]["estimated_wait_hours"] == pytest.approx(6 - 48 / 60)


def test_rework(small_events):
    assert rows(performance.rework_summary(small_events)) == [
        {"activity": "Inspect", "affected_cases": 1, "repeat_events": 2, "mean_occurrences": 3.0}
    ]
    assert performance.rework_summary(small_events.where("case_id != 'K-9'")).count() == 0


def test_workload(small_events):
    from pyspark.sql import functions as F

    table = sorted(rows(performance.resource_workload(small_events)),
                   key=lambda r: -r["processing_hours"])
    assert table[0]["resource_id"] == "LAB-5"
    assert sum(r["workload_share"] for r in table) == pytest.approx(1)
    idle = small_events.withColumn("processing_minutes", F.lit(0.0))
    assert {r["workload_share"] for r in rows(performance.resource_workload(idle))} == {0.0}
    nobody = small_events.withColumn("resource_id", F.lit(None).cast("string"))
    assert performance.resource_workload(nobody).count() == 0


def test_start_end_sample_and_footprint(spark, small_log):
    ends = {(r["position"], r["activity"]): r["case_count"]
            for r in rows(discovery.start_end_activities(small_log))}
    assert ends == {("start", "Intake"): 3, ("end", "Ship"): 3}
    assert rows(discovery.sample_edge_count(small_log, 1)) == [{"sample_cases": 1, "dfg_edges": 3}]
    edges = discovery.edge_counts(small_log)
    relations = {(r["source"], r["target"]): r["relation"] for r in rows(discovery.footprint(edges))}
    assert relations["Inspect", "Pack"] == "->"
    assert relations["Pack", "Inspect"] == "<-"
    assert relations["Inspect", "Inspect"] == "||"
    model = discovery.path_edges(spark, ("Intake", "Inspect", "Bill"))
    status = {(r["source"], r["target"]): r["status"]
              for r in rows(discovery.model_edge_check(edges, model))}
    assert status["Inspect", "Bill"] == "model_only"
    assert status["Intake", "Inspect"] == "both"
    assert status["Intake", "Ship"] == "log_only"


def test_log_format(small_events):
    assert discovery.log_format(small_events).columns == [
        "case:concept:name", "concept:name", "time:timestamp", "resource_id"
    ]


def test_published_scores(spark):
    # Published total wait, p90 wait, coverage and score of four activities.
    published = [
        ("Goods Received", 865100.2425, 120.18008333333333, 1.0, 0.9241859786271567),
        ("Invoice Received", 348031.5563888889, 45.7935, 1.0, 0.45669007561134545),
        ("Delivery Delayed", 155821.00305555554, 160.82194444444445, 0.12925,
         0.41845295793224135),
        ("Manager Approval", 166426.90722222222, 22.79255555555556, 0.872, 0.2791259371542846),
    ]
    table = spark.createDataFrame(
        published, "activity string, total_wait_hours double, p90_wait_hours double, "
        "case_coverage double, expected double")
    for row in rows(performance.score_bottlenecks(table)):
        assert row["bottleneck_score"] == pytest.approx(row["expected"], abs=1e-12)
