"""What keeps the report's work in line with the rows: weights side by side, compiled code, traces
that are gathered once, joins of orders and lines without sorts."""

from __future__ import annotations

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from helpers import SF
from tracewright.functions import dealing
from tracewright.functions.columns import whole
from tracewright.functions.draws import digest, drawn, drawn_below, uniform
from tracewright.log import ProcessLog
from tracewright.operators import conformance, discovery, scenarios
from tracewright.plans.queries import ORDER_STAGES, registry
from tracewright.sources import adapters


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def odd_outcomes(spark):
    """Ties, one crowded cell, null and negative cycles, null targets, manual times of 60 bits."""
    rows = [
        (f"c{i}", i * 977_000_000, None if i % 7 == 0 else 10.0 * (i % 3), s, f"s{s}",
         None if i % 11 == 0 else (i % 5 - 1) * 40_000_000 + i % 3 + s,
         None if i % 13 == 0 else (1 << 58) - i if i % 17 == 0 else 60_000_000 * (i % 4 - 1))
        for i in range(400) for s in (0, 1)]
    rows += [("alone", 5, None, 2, "s2", None, None), ("c1", 8, 1.0, 2, "s2", 7, 1)] * 2
    return spark.createDataFrame(
        rows, "case_id string, arrival_us long, sla_target_hours double, catalog_index int,"
              " scenario string, cycle_us long, manual_us long")


@pytest.mark.parametrize("bound", [None, 30])
def test_wide_weights_give_the_same_metrics(spark, bound):
    outcomes = odd_outcomes(spark)
    drawn_rows = scenarios.replicated(outcomes, 10)
    wide = scenarios.replicated(outcomes, 10, wide=True)
    assert wide.count() == outcomes.count()
    there = scenarios.replication_outcomes(drawn_rows, bound)
    here = scenarios.replication_outcomes(wide, bound)
    assert here.columns == there.columns
    assert len(sorted_rows(there)) >= 20
    assert sorted_rows(here) == sorted_rows(there)


def test_replications_make_no_row_per_draw(spark):
    for name in ("scenario_outcomes", "scenario_compare"):
        assert "posexplode" not in plan_of(registry()[name](spark, SF))


def test_draws_compare_as_text(spark):
    limits = (*scenarios.POISSON_LIMITS, 0.0, 0.5, 1.0)
    draws = spark.range(2000).select(digest("x", F.col("id")).alias("h"))
    differs = [F.count_if((uniform(F.col("h"), k) < x) != (drawn(F.col("h"), k) < drawn_below(x)))
               for k in range(5) for x in limits if x < 1]
    assert not any(draws.agg(*differs).first())


def test_what_if_is_compiled(spark):
    """Java interprets methods of over 8,000 bytes for good."""
    log = ProcessLog(adapters.order_process_events(spark, SF), adapters.ORDER_SORT)
    log.facts  # noqa: B018
    cases = adapters.order_process_cases(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        outcomes = scenarios.what_if(log, ORDER_STAGES, cases)
        for df in (outcomes, scenarios.replicated(outcomes, 24)):
            code = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
            sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", code)]
            assert sizes and max(sizes) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_whole_rounds_like_round(spark):
    values = [0.0, 0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 1e15 + 0.5,
              4503599627370497.0, 9007199254740993.0, -1e17, 2.4999999999999996, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = df.select(whole(F.col("v")), F.round("v").cast("bigint")).collect()
    assert [r[0] for r in found] == [r[1] for r in found]


def test_written_traces_serve_all_readers(spark, small_events):
    for limit in (100_000, 3):
        log = ProcessLog(small_events, case_limit=limit)
        readers = (discovery.start_end_activities, discovery.variants, lambda x: (
            conformance.conformance_cases(conformance.conformance_arrays(x, ("Intake", "Ship")))))
        before = [sorted_rows(read(log)) for read in readers]
        log.traces = discovery.trace_arrays(log).cache()
        assert [sorted_rows(read(log)) for read in readers] == before
        assert replace(log, events=small_events.limit(1)).traces is None


def test_orders_meet_lines_without_sorts(spark, monkeypatch):
    monkeypatch.setattr(dealing, "TASK_ROWS", 500)
    plan = plan_of(adapters.order_process_events(spark, SF))
    assert re.search(r"ShuffledHashJoin \[case_id", plan)
    assert not re.search(r"SortMergeJoin \[case_id", plan)


def test_lines_of_the_case_master_shuffle_once(spark):
    plan = plan_of(adapters.order_process_cases(spark, SF))
    assert not re.search(r"hashpartitioning\(case_id#\d+, l_returnflag", plan)
