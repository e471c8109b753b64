"""Shape of the physical plans: what must not and what must appear in them."""

from __future__ import annotations

import re

import pytest

from helpers import SF
from tracewright.plans.queries import registry

ML = {"sla_metrics", "risk_scores", "risk_bands", "drivers", "review_queue", "subgroup_errors",
      "risk_measures", "high_risk_transitions", "report_json", "report_sections",
      "fit_certificate"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry()) - ML))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(registry()[name](spark, SF))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert banned not in plan, banned


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(registry()["dfg_view"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas
    for schema in schemas:
        names = {part.split(":")[0] for part in schema.split(",")}
        assert names == {"event_id", "ts", "user_id", "event_type"}


def test_filter_reaches_the_scan(spark):
    from tracewright.sources import adapters

    events = adapters.clickstream_events(spark, SF, "day").where("activity = 'purchase'")
    assert "EqualTo(event_type,purchase)" in plan_of(events.select("case_id"))


def test_transitions_shuffle_once(spark):
    plan = plan_of(registry()["transition_waits"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1


def test_conformance_shuffles_once(spark):
    plan = plan_of(registry()["conformance_cases"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1
