from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from helpers import SF, rows
from tracewright.log import ProcessLog
from tracewright.model import CASE_COLUMNS, EVENT_COLUMNS
from tracewright.operators import contracts, discovery, measures, performance
from tracewright.plans import pipeline, run, views
from tracewright.session import durable
from tracewright.sources import adapters, files, sinks

BPMN = """<?xml version="1.0" encoding="UTF-8"?>
<bpmn:definitions xmlns:bpmn="http://www.omg.org/spec/BPMN/20100524/MODEL">
  <bpmn:process id="p">
    <bpmn:startEvent id="s" name="Need"/>
    <bpmn:task id="a" name="Ask"/>
    <bpmn:userTask id="b" name="Check"/>
    <bpmn:exclusiveGateway id="g" name="Ok?"/>
    <bpmn:serviceTask id="c" name="Pay"/>
    <bpmn:endEvent id="e" name="Done"/>
    <bpmn:sequenceFlow id="f1" sourceRef="s" targetRef="a"/>
    <bpmn:sequenceFlow id="f2" sourceRef="a" targetRef="b"/>
    <bpmn:sequenceFlow id="f3" sourceRef="b" targetRef="g"/>
    <bpmn:sequenceFlow id="f4" sourceRef="g" targetRef="c"/>
    <bpmn:sequenceFlow id="f5" sourceRef="g" targetRef="a"/>
    <bpmn:sequenceFlow id="f6" sourceRef="c" targetRef="e"/>
  </bpmn:process>
</bpmn:definitions>
"""


@pytest.fixture(scope="module")
def process(spark):
    """A log that keeps its contract: the clicks of a user's week."""
    events = durable(adapters.clickstream_events(spark, SF, "week"))
    return events, durable(adapters.clickstream_cases(spark, SF, "week"))


def test_click_log_keeps_the_contract(process):
    events, cases = process
    assert tuple(events.columns) == EVENT_COLUMNS
    assert tuple(cases.columns) == CASE_COLUMNS
    contracts.load(events, cases)
    assert sum(rows(contracts.domain_violations(cases))[0].values()) == 0


def test_order_process(spark):
    """Every order with its own lines; what the case master declares is what the log holds."""
    events = adapters.order_process_events(spark, SF)
    cases = durable(adapters.order_process_cases(spark, SF))
    assert tuple(cases.columns) == CASE_COLUMNS
    assert cases.count() == spark.read.parquet(f"{SF}/orders.parquet").count()
    contracts.reconcile(events, cases)
    found = performance.case_performance(events).join(cases, "case_id")
    assert found.where("rework_event_count <> rework_count").isEmpty()
    assert 0.2 < cases.agg(F.avg(F.col("sla_breached").cast("int"))).first()[0] < 0.8


def test_resources(spark, tmp_path):
    (tmp_path / "resources.csv").write_text(
        "resource_id,resource_role,team,fte_capacity,hourly_cost_usd\n"
        "CL-01,Clerk,Intake,1,31\nBOT-07,Robot,Automation,0,0\n")
    table = files.scan_resources_csv(spark, str(tmp_path / "resources.csv"))
    assert [tuple(r) for r in table.orderBy("resource_id").collect()] == [
        ("BOT-07", "Robot", "Automation", 0, 0), ("CL-01", "Clerk", "Intake", 1, 31)]


def test_csv_round_trip(spark, process, tmp_path):
    events, cases = process
    for name, df in (("events", events), ("cases", cases)):
        df.select(*[
            F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c) if t == "timestamp" else c
            for c, t in df.dtypes
        ]).write.option("header", True).option("compression", "gzip").csv(str(tmp_path / name))
    loaded, loaded_cases = contracts.load(
        files.scan_events_csv(spark, str(tmp_path / "events")),
        files.scan_cases_csv(spark, str(tmp_path / "cases")),
    )
    same = [F.col(c).cast("string").alias(c) for c in EVENT_COLUMNS]
    assert loaded.select(*same).exceptAll(events.select(*same)).isEmpty()
    assert loaded_cases.count() == cases.count()


def test_bpmn_and_ideal(spark, tmp_path):
    (tmp_path / "model.bpmn").write_text(BPMN)
    (tmp_path / "ideal.json").write_text(json.dumps({
        "process": "p", "version": "1", "activities": ["Ask", "Check", "Pay", "Ship"],
        "sla_targets_hours": {"Urgent": 120}}, indent=2))
    nodes = files.scan_bpmn_nodes(spark, str(tmp_path / "model.bpmn"))
    flows = files.scan_bpmn_flows(spark, str(tmp_path / "model.bpmn"))
    ideal = files.scan_ideal_process(spark, str(tmp_path / "ideal.json"))
    assert nodes.where("is_task").count() == 3
    assert flows.count() == 6
    assert {(r["source"], r["target"]) for r in rows(files.bpmn_task_edges(nodes, flows))} == {
        ("Ask", "Check"), ("Check", "Pay"), ("Check", "Ask")}
    assert [r["activity"] for r in rows(contracts.model_coverage(nodes, ideal))] == ["Ship"]
    assert ideal.first()["sla_targets_hours"] == {"Urgent": 120.0}


def edges_by_search(tasks, flows):
    """Brute force: from each task along flows until the next tasks."""
    out = set()
    for start in tasks:
        todo, seen = [t for s, t in flows if s == start], set()
        while todo:
            node = todo.pop()
            if node in seen:
                continue
            seen.add(node)
            if node in tasks:
                out.add((tasks[start], tasks[node]))
            else:
                todo += [t for s, t in flows if s == node]
    return out


def test_edges_through_any_gateways(spark, tmp_path):
    """Chained, parallel and inclusive gateways, an event between tasks, and a cycle of gateways."""
    tasks = {f"t{i}": f"Step {i}" for i in range(6)}
    silent = {"p1": "parallelGateway", "p2": "parallelGateway", "i1": "inclusiveGateway",
              "x1": "exclusiveGateway", "x2": "exclusiveGateway", "v1": "intermediateThrowEvent",
              "s": "startEvent", "e": "endEvent"}
    flows = [("s", "t0"), ("t0", "p1"), ("p1", "i1"), ("p1", "t1"), ("i1", "t2"), ("i1", "x1"),
             ("x1", "x2"), ("x2", "x1"), ("x2", "t3"), ("t1", "p2"), ("t2", "p2"), ("t3", "v1"),
             ("v1", "p2"), ("p2", "t4"), ("t4", "t4"), ("t4", "x2"), ("t4", "e"), ("t5", "e")]
    body = "".join(f'<bpmn:task id="{k}" name="{v}"/>' for k, v in tasks.items())
    body += "".join(f'<bpmn:{v} id="{k}"/>' for k, v in silent.items())
    body += "".join(f'<bpmn:sequenceFlow id="f{i}" sourceRef="{s}" targetRef="{t}"/>'
                    for i, (s, t) in enumerate(flows))
    (tmp_path / "m.bpmn").write_text(
        '<bpmn:definitions xmlns:bpmn="http://www.omg.org/spec/BPMN/20100524/MODEL">'
        f'<bpmn:process id="p">{body}</bpmn:process></bpmn:definitions>')
    nodes = files.scan_bpmn_nodes(spark, str(tmp_path / "m.bpmn"))
    assert {r["node_id"]: r["node_type"] for r in rows(nodes.where("not is_task"))} == silent
    edges = files.bpmn_task_edges(nodes, files.scan_bpmn_flows(spark, str(tmp_path / "m.bpmn")))
    found = [(r["source"], r["target"]) for r in rows(edges)]
    assert len(found) == len(set(found))
    assert set(found) == edges_by_search(tasks, flows)
    assert ("Step 0", "Step 3") in found and ("Step 4", "Step 3") in found
    none = files.bpmn_task_edges(nodes.where("not is_task"), files.scan_bpmn_flows(
        spark, str(tmp_path / "m.bpmn")))
    assert none.isEmpty()


def test_sinks(spark, small_log, tmp_path):
    tables = {"activities": discovery.activity_summary(small_log),
              "traces": discovery.trace_arrays(small_log)}
    sinks.write_tables(tables, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv" / "traces"))
    assert {r["steps"] for r in rows(back)} == {
        "Intake | Inspect | Pack | Ship", "Intake | Ship",
        "Intake | Inspect | Inspect | Inspect | Ship"}
    sinks.write_tables(tables, str(tmp_path / "parquet"), "parquet")
    assert spark.read.parquet(str(tmp_path / "parquet" / "activities")).count() == 4
    first = sinks.records(small_log.events.orderBy("case_id", "event_index"), 1).first()["record"]
    assert json.loads(first)["timestamp"] == "2026-01-03T08:00:00.000Z"


def test_relational_load_is_bucketed(spark, process):
    events, cases = process
    sinks.load_relational(events, cases, cases_table="t_cases", events_table="t_events")
    try:
        table = spark.table("t_events")
        assert dict(table.dtypes)["amount_usd"] == "decimal(14,2)"
        joined = table.join(spark.table("t_cases").hint("merge"), "case_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert joined.count() == events.count()
        stored = ProcessLog(table.withColumnRenamed("event_timestamp", "timestamp"))
        for built in (discovery.transitions(stored), discovery.trace_arrays(stored)):
            assert "Exchange" not in built._jdf.queryExecution().executedPlan().toString()
        edges = discovery.edge_counts(stored)
        plain = discovery.edge_counts(ProcessLog(events))
        assert {tuple(r) for r in edges.collect()} == {tuple(r) for r in plain.collect()}
    finally:
        spark.sql("DROP TABLE t_events")
        spark.sql("DROP TABLE t_cases")


def test_relational_load_of_long_cases_is_spread(spark, process):
    events, cases = process
    sinks.load_relational(events, cases, cases_table="u_cases", events_table="u_events",
                          case_limit=5)
    try:
        table = spark.table("u_events")
        assert table.count() == events.count()
        detail = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED u_events").collect()}
        assert "Num Buckets" not in detail
    finally:
        spark.sql("DROP TABLE u_events")
        spark.sql("DROP TABLE u_cases")


def test_report(process, tmp_path):
    events, cases = process
    analysis = pipeline.analyze(ProcessLog(events), cases)
    assert set(analysis.tables) == {
        "activities", "bottlenecks", "case_conformance", "case_performance", "deviations",
        "directly_follows_graph", "resource_workload", "rework", "risk_predictions",
        "sla_model_drivers", "simulation_scenarios", "variants"}
    sinks.write_report(analysis.report, str(tmp_path / "report"))
    text = "\n".join(p.read_text() for p in (tmp_path / "report").glob("part-*"))
    report = json.loads(text)
    assert set(report) == {
        "project", "data_quality", "kpis", "process_discovery", "conformance", "performance",
        "sla_prediction", "capacity_simulation", "governance"}
    assert report["data_quality"]["event_count"] == events.count()
    discovered = report["process_discovery"]
    counts = [v["case_count"] for v in discovered["top_variants"]]
    assert counts == sorted(counts, reverse=True)
    assert len(discovered["top_variants"]) <= 12
    assert pipeline.summary(analysis.report).columns == [
        "project", "data_quality", "kpis", "recommendation"]
    for name in pipeline.SECTIONS:
        assert pipeline.section(analysis.report, name).count() == 1


def test_run_from_files(spark, process, tmp_path):
    events, cases = process
    for name, df in (("e.csv", events), ("c.csv", cases)):
        df.select(*[
            F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c) if t == "timestamp" else c
            for c, t in df.dtypes
        ]).write.option("header", True).csv(str(tmp_path / name))
    paths = {"report_path": str(tmp_path / "report"), "tables_dir": str(tmp_path / "tables"),
             "runs_path": str(tmp_path / "runs")}
    analysis = run.run_analysis(
        spark, str(tmp_path / "e.csv"), str(tmp_path / "c.csv"), **paths)
    assert len(list((tmp_path / "tables").iterdir())) == 12
    with pytest.raises(contracts.ContractError):
        run.run_analysis(spark, str(tmp_path / "c.csv"), str(tmp_path / "e.csv"), **paths)
    logged = spark.read.parquet(paths["runs_path"])
    assert {r["status"]: r["events_loaded"] for r in rows(logged)} == {
        "success": events.count(), "failure": None}
    imported = measures.import_tables(analysis.tables)
    assert dict(imported["risk_predictions"].dtypes)["predicted_breach"] == "boolean"
    assert imported["case_performance"].count() == cases.count()


def test_sql_views(spark, process):
    events, cases = process
    views.register_views(spark, events, cases)
    assert spark.table("vw_case_performance").count() == cases.count()
    got = {tuple(r) for r in spark.table("vw_sla_performance").select(
        "completed_month", "business_unit", "priority", "case_count").collect()}
    want = {tuple(r) for r in performance.sla_monthly(cases).select(
        "completed_month", "business_unit", "priority", "case_count").collect()}
    assert got == want
    for name in views.REPORTS:
        assert spark.sql(f"SELECT * FROM {name}").count() > 0
    assert spark.table("vw_activity_performance").count() == 5


def test_csv_files_with_another_header_order_are_an_error(spark, tmp_path):
    from tracewright.sources.files import _raw_csv

    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n")
    with pytest.raises(Exception, match="header"):
        _raw_csv(spark, str(tmp_path)).collect()
