"""Query registry: every operator on the given tables, as ``name -> (spark, sf_dir) -> rows``.

The click log stands for a process with many variants (cases per user and day, or week), the
order lines for an unchecked log with real defects, and orders with their lines, customers and
suppliers for a process with amounts, partners, targets and outcomes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.functions.columns import iso_time, share
from tracewright.log import ProcessLog
from tracewright.model import SCHEMA_CONSTRAINTS
from tracewright.operators import (
    conformance,
    contracts,
    discovery,
    measures,
    monitoring,
    performance,
    prediction,
    scenarios,
)
from tracewright.plans.pipeline import SECTIONS, Analysis, analyze, section, summary
from tracewright.plans.views import register_views
from tracewright.sources import adapters, files
from tracewright.session import durable

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

# Levers of the scenario catalog on the click log.
CLICK_STAGES = scenarios.StageMap(
    {"Manager Approval": "view", "Purchase Order Created": "click",
     "Invoice Matched": "purchase"},
    lead_time_activities=("signup",),
    rework_activities=("error",),
)
ORDER_STAGES = scenarios.StageMap(
    {"Manager Approval": "Goods Accepted", "Goods Received": "Goods Shipped",
     "Invoice Matched": "Order Closed"},
    lead_time_activities=("Goods Shipped",),
    rework_activities=("Goods Returned",),
)
REPLICATIONS = 24
SCENARIO_GROUPS = REPLICATIONS * len(scenarios.CATALOG)
ORDER_MODEL = "order_process.bpmn"
# The four published patterns, and the assigned tokens that the texts hold.
TEXT_SECRETS = {**contracts.SECRET_PATTERNS, "assigned token": r'\btoken = "[0-9a-f]{40}"'}
DRIFT_CUT = "2024-01-16"
RECENT_FROM = "2000-01-01"
CLICK_SLICERS = measures.SLICERS


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Output form: doubles rounded, timestamps as ISO text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(column, digits)
        elif isinstance(field.dataType, T.TimestampType):
            column = iso_time(column)
        elif isinstance(field.dataType, T.DecimalType) and field.dataType.scale == 0:
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = lambda spark, sf_dir: tidy(fn(spark, sf_dir))
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


# What one application works on: the logs with their size facts, and the model fitted on one.
_made: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf: str, name: str, build):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _made:
        _made[key] = build()
    return _made[key]


def _clicks(spark, sf, grain) -> ProcessLog:
    return _once(
        spark, sf, grain, lambda: ProcessLog(adapters.clickstream_events(spark, sf, grain))
    )


def _day(spark, sf) -> ProcessLog:
    return _clicks(spark, sf, "day")


def _week(spark, sf) -> ProcessLog:
    return _clicks(spark, sf, "week")


def _cases(spark, sf) -> DataFrame:
    return adapters.clickstream_cases(spark, sf, "week")


def _day_conformance(spark, sf) -> DataFrame:
    return conformance.conformance_arrays(_day(spark, sf), adapters.CLICK_IDEAL)


@dataclass(frozen=True)
class _OrderProcess:
    log: ProcessLog
    cases: DataFrame


def _orders(spark, sf) -> _OrderProcess:
    return _once(spark, sf, "orders", lambda: _OrderProcess(
        ProcessLog(adapters.order_process_events(spark, sf), adapters.ORDER_SORT),
        adapters.order_process_cases(spark, sf)))


def _order_features(spark, sf) -> DataFrame:
    process = _orders(spark, sf)
    return prediction.sla_features(
        process.log, process.cases, adapters.ORDER_DECISION, adapters.ORDER_APPROVAL,
        adapters.ORDER_REWORK)


def _model(spark, sf) -> prediction.SlaModel:
    def build():
        return prediction.train_sla_model(_order_features(spark, sf))

    return _once(spark, sf, "model", build)


def _analysis(spark, sf) -> Analysis:
    def build():
        process = _orders(spark, sf)
        return analyze(
            process.log, process.cases, adapters.ORDER_IDEAL, ORDER_STAGES,
            adapters.ORDER_DECISION, adapters.ORDER_APPROVAL, adapters.ORDER_REWORK,
            {"process": "Orders"},
        )

    return _once(spark, sf, "analysis", build)


# --- contracts and data quality -----------------------------------------------------------


@query
def dq_summary(spark, sf):
    log = _day(spark, sf)
    total = discovery.variant_counts(log).select(F.count(F.lit(1)))
    return contracts.quality_summary(log.events, total)


@query
def dq_violations(spark, sf):
    return contracts.event_violations(contracts.typed_events(adapters.line_events(spark, sf)))


@query
def dq_case_violations(spark, sf):
    return contracts.case_violations(contracts.typed_cases(adapters.order_cases(spark, sf)))


@query
def dq_duplicate_keys(spark, sf):
    return contracts.duplicate_keys(adapters.line_events(spark, sf), ["case_id", "event_index"])


@query
def dq_null_required(spark, sf):
    return contracts.null_required(
        adapters.order_cases(spark, sf),
        ["case_id", "created_at", "completed_at", "priority", "event_count"],
    )


@query
def dq_ts_regression(spark, sf):
    return contracts.timestamp_regressions(
        adapters.line_events(spark, sf), ("event_index", "part", "timestamp")
    )


@query
def dq_case_reconcile(spark, sf):
    return contracts.case_set_difference(
        adapters.line_events(spark, sf), adapters.read(spark, sf, "orders").select(
            F.col("o_orderkey").cast("string").alias("case_id"), F.lit(1).alias("event_count"))
    )


@query
def dq_count_reconcile(spark, sf):
    return contracts.count_mismatches(
        adapters.line_events(spark, sf), adapters.order_cases(spark, sf)
    )


@query
def dq_constraints(spark, sf):
    """The schema's constraints on what the order tables have of its columns, and two more keys."""
    tables = {"process_cases": adapters.order_cases(spark, sf),
              "process_events": adapters.line_events(spark, sf)}
    rules = [c for c in SCHEMA_CONSTRAINTS if set(c[2]) <= set(tables[c[0]].columns)]
    rules += [("process_cases", "foreign key", ("case_id",), "process_events(case_id)"),
              ("process_events", "unique", ("case_id", "part"), None)]
    return contracts.constraint_violations(tables, contracts.constraint_table(spark, rules))


@query
def dq_domain(spark, sf):
    return contracts.domain_violations(adapters.order_cases(spark, sf))


@query
def dq_text_violations(spark, sf):
    """The event rules on a feed of text, where parsing is what fails."""
    return contracts.event_violations(contracts.typed_events(adapters.line_text(spark, sf)))


@query
def dq_golden(spark, sf):
    """Totals of the order log against what other tables declare: the orders' own count and value,
    the line numbers, and the lines of closed orders."""
    events = _orders(spark, sf).log.events
    supplied = F.col("resource_role") == "Supplier"
    actual = events.agg(
        F.count_if(F.col("activity") == "Order Placed").cast("double").alias("orders"),
        F.count_if(supplied).cast("double").alias("lines"),
        F.sum(F.when(supplied, F.col("amount_usd").cast("decimal(14,2)"))).cast("double")
        .alias("order_value"),
        F.count_if(F.col("activity") == "Order Closed").cast("double").alias("closed_orders"),
    )
    orders = adapters.read(spark, sf, "orders")
    numbers = adapters.read(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_linenumber").alias("n")).agg(F.sum("n").cast("double").alias("lines"))
    declared = orders.agg(
        F.count(F.lit(1)).cast("double").alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(14,2)")).cast("double").alias("order_value"),
        F.count_if(F.col("o_orderstatus") == "F").cast("double").alias("closed_orders"),
    ).select("*", numbers.scalar().alias("lines"))
    names = ["orders", "lines", "order_value", "closed_orders"]
    value = actual.unpivot([], names, "metric", "value")
    expected = declared.select(*names).unpivot([], names, "metric", "expected").withColumn(
        "tolerance", F.lit(1e-4)
    )
    return contracts.golden_check(value, expected)


@query
def dq_secret_scan(spark, sf):
    return contracts.secret_summary(
        adapters.read(spark, sf, "documents"), patterns=TEXT_SECRETS)


@query
def dq_secret_findings(spark, sf):
    return contracts.secret_findings(
        adapters.read(spark, sf, "documents"), "doc_id", patterns=TEXT_SECRETS)


# --- discovery ----------------------------------------------------------------------------


@query
def variants(spark, sf):
    return discovery.variants(_day(spark, sf)).drop("cumulative_share")


@query
def variant_coverage(spark, sf):
    return discovery.variants(_day(spark, sf)).select(
        "variant_rank", "case_count", "cumulative_share"
    )


@query
def variants_conversations(spark, sf):
    return discovery.variants(ProcessLog(adapters.chat_events(spark, sf)))


@query
def variants_orders(spark, sf):
    return discovery.variants(_orders(spark, sf).log)


@query
def case_sequences(spark, sf):
    return discovery.case_sequences(_day(spark, sf))


@query
def variant_steps(spark, sf):
    return discovery.variant_steps(_day(spark, sf))


@query
def dfg(spark, sf):
    return discovery.directly_follows(_day(spark, sf))


@query
def dfg_orders(spark, sf):
    return discovery.directly_follows(_orders(spark, sf).log)


@query
def dfg_view(spark, sf):
    return discovery.directly_follows_view(_day(spark, sf))


@query
def activity_summary(spark, sf):
    return discovery.activity_summary(_day(spark, sf))


@query
def activity_view(spark, sf):
    return discovery.activity_view(adapters.clickstream_events(spark, sf, "day"))


@query
def start_end_activities(spark, sf):
    return discovery.start_end_activities(_day(spark, sf))


@query
def dfg_sample(spark, sf):
    return discovery.sample_edge_count(_day(spark, sf))


@query
def log_format(spark, sf):
    return discovery.log_format(adapters.clickstream_events(spark, sf, "day"))


@query
def footprint(spark, sf):
    return discovery.footprint(discovery.edge_counts(_orders(spark, sf).log))


@query
def model_edge_check(spark, sf):
    """Observed edges against those of the order model, a BPMN file with chained gateways."""
    path = files.packaged_model(spark, ORDER_MODEL)
    model = files.bpmn_task_edges(
        files.scan_bpmn_nodes(spark, path), files.scan_bpmn_flows(spark, path))
    return discovery.model_edge_check(discovery.edge_counts(_orders(spark, sf).log), model)


@query
def activity_drift(spark, sf):
    events = adapters.clickstream_events(spark, sf, "day")
    cut = F.col("timestamp") >= F.lit(DRIFT_CUT).cast("timestamp")
    return discovery.label_drift(
        events.where(cut), events.where(~cut), ("activity", "source_system")
    )


# --- conformance --------------------------------------------------------------------------


@query
def conformance_cases(spark, sf):
    return conformance.conformance_cases(_day_conformance(spark, sf))


@query
def deviations(spark, sf):
    return conformance.deviation_summary(_day_conformance(spark, sf))


@query
def deviations_orders(spark, sf):
    log = _orders(spark, sf).log
    return conformance.deviation_summary(conformance.conformance_arrays(log, adapters.ORDER_IDEAL))


@query
def fitness_histogram(spark, sf):
    return conformance.fitness_histogram(_day_conformance(spark, sf))


@query
def conformance_split(spark, sf):
    return conformance.conformance_split(_day_conformance(spark, sf))


@query
def reordered_cases(spark, sf):
    return conformance.reordered_cases(_day_conformance(spark, sf))


@query
def trace_distances(spark, sf):
    """Each day of a user against the day before."""
    traces = discovery.trace_arrays(_day(spark, sf), whole=True)
    user, day = (F.split_part("case_id", F.lit("|"), F.lit(i)) for i in (1, 2))
    return conformance.trace_distances(
        traces.withColumns({"user": user, "day": day}), ["user"], ["day"])


# --- performance --------------------------------------------------------------------------


@query
def transition_waits(spark, sf):
    return discovery.transition_waits(_week(spark, sf))


@query
def bottlenecks(spark, sf):
    return performance.bottlenecks(_week(spark, sf))


@query
def bottlenecks_orders(spark, sf):
    return performance.bottlenecks(_orders(spark, sf).log)


@query
def case_performance(spark, sf):
    return performance.case_performance(adapters.clickstream_events(spark, sf, "week"))


@query
def rework(spark, sf):
    return performance.rework_summary(adapters.clickstream_events(spark, sf, "week"))


@query
def resource_workload(spark, sf):
    return performance.resource_workload(_week(spark, sf))


@query
def sla_consumption(spark, sf):
    return performance.sla_consumption(_cases(spark, sf))


@query
def sla_monthly(spark, sf):
    return performance.sla_monthly(_orders(spark, sf).cases)


def _sql(spark, sf, text) -> DataFrame:
    register_views(spark, _day(spark, sf).events, _cases(spark, sf))
    return spark.sql(text)


@query
def sql_directly_follows(spark, sf):
    return _sql(spark, sf, "SELECT * FROM vw_directly_follows")


@query
def sql_case_performance(spark, sf):
    return _sql(spark, sf, "SELECT * FROM vw_case_performance")


@query
def sql_sla_by_country(spark, sf):
    """An ad-hoc query over the base table."""
    return _sql(
        spark, sf,
        "SELECT country, vendor_tier, count(*) AS cases, count_if(sla_breached) AS breached "
        "FROM process_cases GROUP BY country, vendor_tier",
    )


@query
def top_wait_transitions(spark, sf):
    return discovery.top_wait_transitions(discovery.directly_follows_view(_day(spark, sf)))


@query
def bu_sla_gap(spark, sf):
    return performance.bu_sla_gap(_cases(spark, sf))


@query
def rework_concentration(spark, sf):
    return performance.rework_concentration(_cases(spark, sf))


def _enriched(spark, sf) -> DataFrame:
    log = _week(spark, sf)
    return performance.enrich_cases(
        _cases(spark, sf),
        conformance.conformance_arrays(log, adapters.CLICK_IDEAL),
        performance.case_performance(log.events),
    )


@query
def case_enriched(spark, sf):
    return _enriched(spark, sf)


@query
def kpis(spark, sf):
    log = _week(spark, sf)
    return performance.kpis(
        log.events, _cases(spark, sf),
        conformance.conformance_arrays(log, adapters.CLICK_IDEAL),
        performance.case_performance(log.events),
    )


@query
def kpis_orders(spark, sf):
    process = _orders(spark, sf)
    return performance.kpis(
        process.log.events, process.cases,
        conformance.conformance_arrays(process.log, adapters.ORDER_IDEAL),
        performance.case_performance(process.log.events),
    )


@query
def case_explorer(spark, sf):
    log = _week(spark, sf)
    return performance.case_explorer(
        _cases(spark, sf), conformance.conformance_arrays(log, adapters.CLICK_IDEAL),
        discovery.case_variants(log),
    )


@query
def case_timeline(spark, sf):
    return performance.case_timeline(_week(spark, sf), _cases(spark, sf))


@query
def segment_sla(spark, sf):
    return performance.segment_sla(_week(spark, sf), _cases(spark, sf))


@query
def breach_transitions(spark, sf):
    breached = _cases(spark, sf).where("sla_breached")
    return performance.dominant_transitions(_week(spark, sf), breached)


# --- SLA risk -----------------------------------------------------------------------------


@query
def sla_features(spark, sf):
    return _order_features(spark, sf)


@query
def sla_features_clicks(spark, sf):
    features = prediction.sla_features(
        _week(spark, sf), _cases(spark, sf), adapters.CLICK_DECISION, adapters.CLICK_APPROVAL,
        adapters.CLICK_REWORK,
    )
    return features.select(
        "case_id", "po_created_at", "elapsed_to_po_hours", "early_event_count",
        "approval_count", "early_rework_count", "early_manual_minutes",
    )


@query
def temporal_split(spark, sf):
    cases = _orders(spark, sf).cases.select("case_id", "created_at")
    return prediction.temporal_split(cases)


def _baseline_scores(spark, sf) -> DataFrame:
    """The score a planner has without a model: share of the SLA target used at the cut."""
    features = _order_features(spark, sf)
    used = share(F.col("elapsed_to_po_hours"), F.col("sla_target_hours"))
    # Two decimals, so that scores tie as they do for a coarse rule; lines may ship before the order.
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.round(used, 2)))
    return features.withColumn("risk_score", score).withColumn(
        "predicted_breach", F.col("risk_score") >= prediction.SCORE_THRESHOLD
    )


@query
def baseline_metrics(spark, sf):
    scored = durable(_baseline_scores(spark, sf).select(
        "risk_score", "sla_breached", "predicted_breach", "vendor_tier"
    ))
    keys = ["vendor_tier"]
    return prediction.threshold_metrics(scored, keys).join(
        prediction.rank_metrics(scored, keys), keys
    )


@query
def baseline_metrics_total(spark, sf):
    scored = durable(_baseline_scores(spark, sf).select("risk_score", "sla_breached"))
    return prediction.rank_metrics(scored)


@query
def baseline_changes(spark, sf):
    """Ranking quality of the rule on recent cases against the earlier ones, by vendor tier."""
    scored = durable(_baseline_scores(spark, sf).select(
        "risk_score", "sla_breached", "vendor_tier", "created_at"
    ))
    recent = F.col("created_at") >= F.lit(RECENT_FROM).cast("timestamp")
    keys = ["vendor_tier"]
    return prediction.metric_changes(
        prediction.rank_metrics(scored.where(recent), keys),
        prediction.rank_metrics(scored.where(~recent), keys), keys,
    )


@query
def baseline_bands(spark, sf):
    scored = _baseline_scores(spark, sf).withColumn(
        "risk_band", prediction.risk_band(F.col("risk_score"))
    )
    return prediction.risk_distribution(scored)


def _rule_scored(spark, sf) -> DataFrame:
    return prediction.scored_output(_baseline_scores(spark, sf))


@query
def rule_scores(spark, sf):
    return _rule_scored(spark, sf)


@query
def rule_queue(spark, sf):
    return prediction.review_queue(_rule_scored(spark, sf))


@query
def rule_subgroups(spark, sf):
    scored = durable(_rule_scored(spark, sf))
    return prediction.subgroup_metrics(scored, ("priority", "vendor_tier", "business_unit"))


@query
def rule_measures(spark, sf):
    return measures.risk_measures(_rule_scored(spark, sf), ["business_unit"])


@query
def rule_transitions(spark, sf):
    chosen = _rule_scored(spark, sf).where("risk_band in ('High', 'Critical')")
    return performance.dominant_transitions(_orders(spark, sf).log, chosen)


@query
def sla_metrics(spark, sf):
    return _model(spark, sf).metrics.select("*", "confusion_matrix.*").drop("confusion_matrix")


@query
def risk_scores(spark, sf):
    return _model(spark, sf).scored


@query
def risk_bands(spark, sf):
    return prediction.risk_distribution(_model(spark, sf).scored)


@query
def fit_certificate(spark, sf):
    """The gradient at the fitted coefficients, to five digits: zero in every feature."""
    found = prediction.fit_certificate(_model(spark, sf))
    return found.select("feature", F.round(F.abs("gradient"), 5).alias("gradient"))


@query
def drivers(spark, sf):
    return _model(spark, sf).drivers


@query
def review_queue(spark, sf):
    return prediction.review_queue(_model(spark, sf).scored)


@query
def subgroup_errors(spark, sf):
    return prediction.subgroup_metrics(
        _model(spark, sf).scored, ("priority", "vendor_tier", "business_unit")
    )


@query
def high_risk_transitions(spark, sf):
    chosen = _model(spark, sf).scored.where("risk_band in ('High', 'Critical')")
    return performance.dominant_transitions(_orders(spark, sf).log, chosen)


# --- scenarios and the order process ------------------------------------------------------


def _outcomes(spark, sf, replications=None) -> DataFrame:
    return scenarios.what_if(
        _week(spark, sf), CLICK_STAGES, _cases(spark, sf), replications=replications)


def _replicated(spark, sf) -> DataFrame:
    return scenarios.replicated(_outcomes(spark, sf, REPLICATIONS), REPLICATIONS, wide=True)


def _compared(spark, sf) -> DataFrame:
    per_replication = scenarios.replication_outcomes(_replicated(spark, sf), SCENARIO_GROUPS)
    return scenarios.compare(
        scenarios.mean_outcomes(per_replication), scenarios.catalog_table(spark)
    )


@query
def whatif_observed(spark, sf):
    return _outcomes(spark, sf)


@query
def scenario_outcomes(spark, sf):
    return scenarios.replication_outcomes(_replicated(spark, sf), SCENARIO_GROUPS)


@query
def scenario_compare(spark, sf):
    return tidy(_compared(spark, sf), 4)


@query
def scenario_recommendation(spark, sf):
    return scenarios.recommend(_compared(spark, sf), by_value=True)


@query
def scenario_measures(spark, sf):
    return tidy(measures.scenario_measures(_compared(spark, sf)), 4)


@query
def order_process(spark, sf):
    return _orders(spark, sf).cases


@query
def order_activities(spark, sf):
    events = adapters.order_process_events(spark, sf)
    return events.groupBy("activity", "resource_role", "source_system", "business_unit").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum(F.col("amount_usd").cast("decimal(14,2)")).cast("double").alias("amount_usd"),
        F.min("timestamp").alias("first_at"),
        F.max("timestamp").alias("last_at"),
    )


# --- measures -----------------------------------------------------------------------------


@query
def measures_by_slicer(spark, sf):
    return measures.case_measures(_enriched(spark, sf), CLICK_SLICERS)


@query
def measures_rollup(spark, sf):
    return measures.case_measures_sets(
        _cases(spark, sf), CLICK_SLICERS, measures.rollup_sets(CLICK_SLICERS)
    )


@query
def measures_cube(spark, sf):
    return measures.case_measures_sets(
        _cases(spark, sf), CLICK_SLICERS, measures.cube_sets(CLICK_SLICERS)
    )


@query
def process_measures(spark, sf):
    log = _day(spark, sf)
    return measures.process_measures(performance.bottlenecks(log), discovery.variants(log))


@query
def risk_measures(spark, sf):
    return measures.risk_measures(_model(spark, sf).scored, ["business_unit"])


# --- monitoring ---------------------------------------------------------------------------


@query
def runs_by_window(spark, sf):
    return monitoring.runs_by_window(adapters.run_log(spark, sf))


@query
def alert_failures(spark, sf):
    return monitoring.failure_alerts(adapters.run_log(spark, sf))


@query
def alert_hold_volume(spark, sf):
    return monitoring.hold_alerts(adapters.run_log(spark, sf), "events_loaded", 100_000, 10)


@query
def alert_hold_adherence(spark, sf):
    return monitoring.hold_alerts(adapters.run_log(spark, sf), "sla_adherence", 0.70, 30)


@query
def duration_p95(spark, sf):
    return monitoring.duration_quantile(adapters.run_log(spark, sf))


@query
def latest_gauges(spark, sf):
    return monitoring.latest_gauges(adapters.run_log(spark, sf))


@query
def alert_hold_by_instance(spark, sf):
    return monitoring.hold_alerts(
        adapters.run_log(spark, sf), "sla_adherence", 0.70, 30, by=["instance"])


@query
def alert_low_sessions(spark, sf):
    """Low samples less than the instance's usual distance apart, as sessions."""
    return monitoring.low_sessions(
        adapters.run_log(spark, sf), "sla_adherence", 0.70, 30, gap_seconds=1800)


def _counters(spark, sf) -> DataFrame:
    return adapters.counter_samples(spark, sf, monitoring.DURATION_BUCKETS)


@query
def counter_increase(spark, sf):
    return monitoring.counter_increase(_counters(spark, sf), "failures")


@query
def counter_alerts(spark, sf):
    return monitoring.increase_alerts(
        monitoring.counter_increase(_counters(spark, sf), "failures"))


@query
def counter_p95(spark, sf):
    return monitoring.counter_quantile(_counters(spark, sf), "durations")


# --- report -------------------------------------------------------------------------------


@query
def report_process_map(spark, sf):
    """The process map's edges: the 20 most frequent."""
    edges = discovery.directly_follows(_orders(spark, sf).log)
    return edges.orderBy(F.desc("transition_count"), "source", "target").limit(20)


@query
def report_top_variants(spark, sf):
    return discovery.variants(_orders(spark, sf).log).where("variant_rank <= 12")


@query
def report_deviations(spark, sf):
    arrays = conformance.conformance_arrays(_orders(spark, sf).log, adapters.ORDER_IDEAL)
    found = conformance.deviation_summary(arrays)
    return found.orderBy(F.desc("case_count"), "deviation_type", "activity").limit(20)


@query
def report_workload(spark, sf):
    """The 15 resources with the most hours."""
    table = performance.resource_workload(_orders(spark, sf).log)
    return table.orderBy(F.desc("processing_hours"), "resource_id", "resource_role").limit(15)


@query
def report_sections(spark, sf):
    """Each section of the report that a reader can ask for, as JSON."""
    report = _analysis(spark, sf).report
    parts = {name: section(report, name) for name in SECTIONS} | {"summary": summary(report)}
    rows = [df.select(F.lit(name).alias("section"), F.to_json(F.struct("*")).alias("body"))
            for name, df in parts.items()]
    return reduce(DataFrame.unionByName, rows)


@query
def report_json(spark, sf):
    return _analysis(spark, sf).report.select(F.to_json("report").alias("report"))
