"""The full analysis: every result table and the one-row report, from a validated log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.columns import iso_time
from tracewright.log import ProcessLog
from tracewright.model import IDEAL_PROCESS
from tracewright.operators import (
    conformance,
    contracts,
    discovery,
    performance,
    prediction,
    scenarios,
)
from tracewright.session import durable


REPLICATIONS = 24

# The governance section.
GOVERNANCE = {
    "decision_mode": "human-in-the-loop",
    "production_mutations": False,
    "prediction_use": "Prioritize analyst review; never approve, reject, or pay an invoice "
                      "without an authorized business control.",
    "model_validation": "Temporal holdout; synthetic data; not production calibrated.",
}


@dataclass(frozen=True)
class Analysis:
    tables: dict[str, DataFrame]
    report: DataFrame


def _top(df: DataFrame, order: Sequence[Column], limit: int | None = None) -> Column:
    """Ordered rows as an array of structs.

    Only for result tables whose size is a label count or a ``limit``.
    """
    rows = df.orderBy(*order)
    rows = rows if limit is None else rows.limit(limit)
    place = F.row_number().over(Window.partitionBy().orderBy(*order))
    row = F.struct(place.alias("place"), F.struct(*df.columns).alias("row"))
    packed = rows.select(row.alias("r")).agg(F.sort_array(F.collect_list("r")).alias("r"))
    return packed.select(F.transform("r", lambda r: r["row"])).scalar()


def _row(df: DataFrame) -> Column:
    return df.select(F.struct(*df.columns)).scalar()


def analyze(
    log: ProcessLog,
    cases: DataFrame,
    ideal: Sequence[str] = IDEAL_PROCESS,
    stages: scenarios.StageMap = scenarios.PURCHASE_TO_PAY,
    decision: str = "Purchase Order Created",
    approval: str = "Manager Approval",
    rework: str = "Request Reworked",
    project: dict[str, str] | None = None,
) -> Analysis:
    """Build the twelve tables and the report.

    Intermediate results that several tables read are written to the checkpoint folder
    once: events and cases, transitions, per-case conformance and performance, and the outcomes
    with their replication weights. Everything after them works on those.
    """
    spark = log.events.sparkSession
    events, cases = durable(log.events), durable(cases)
    log = replace(log, events=events)
    # Read by the conformance, the variants, and the first and last activities.
    log.traces = durable(discovery.trace_arrays(log))
    steps = durable(discovery.transitions(log))
    scored_cases = durable(conformance.conformance_arrays(log, ideal))
    per_case = durable(performance.case_performance(events))

    # The report and the table sinks both read these results.
    variants = durable(discovery.variants(log).drop("cumulative_share"))
    edges = durable(discovery.directly_follows(log, steps))
    activities = durable(discovery.activity_summary(log))
    deviations = durable(conformance.deviation_summary(scored_cases))
    bottlenecks = durable(performance.bottlenecks(log, steps))
    rework_table = durable(performance.rework_summary(events))
    workload = performance.resource_workload(log)
    model = prediction.train_sla_model(
        prediction.sla_features(log, cases, decision, approval, rework)
    )
    outcomes = scenarios.replicated(
        scenarios.what_if(log, stages, cases, replications=REPLICATIONS), REPLICATIONS, wide=True)
    catalog = scenarios.catalog_table(spark)
    compared = durable(scenarios.compare(scenarios.mean_outcomes(scenarios.replication_outcomes(
        outcomes, REPLICATIONS * len(scenarios.CATALOG))), catalog))
    tables = {
        "activities": activities,
        "bottlenecks": bottlenecks,
        "case_conformance": conformance.conformance_cases(scored_cases),
        "case_performance": performance.enrich_cases(cases, scored_cases, per_case),
        "deviations": deviations,
        "directly_follows_graph": edges,
        "resource_workload": workload,
        "rework": rework_table,
        "risk_predictions": model.scored,
        "sla_model_drivers": model.drivers,
        "simulation_scenarios": compared,
        "variants": variants,
    }

    quality = contracts.quality_summary(events, variants.select(F.count(F.lit(1)))).withColumns({
        "start_timestamp": iso_time(F.col("start_timestamp")),
        "end_timestamp": iso_time(F.col("end_timestamp")),
    })
    split = conformance.conformance_split(scored_cases)
    starts = discovery.start_end_activities(log)
    recommendation = scenarios.recommend(compared)
    about = {"process": "Purchase-to-Pay", "currency": "USD", **(project or {})}
    sections = {
        "project": F.struct(*[F.lit(v).alias(k) for k, v in about.items()]),
        "data_quality": _row(quality),
        "kpis": _row(performance.kpis(events, cases, scored_cases, per_case)),
        "process_discovery": F.struct(
            F.array(*[F.lit(a) for a in ideal]).alias("ideal_path"),
            _top(variants, [F.col("variant_rank")], 12).alias("top_variants"),
            _top(edges, [F.desc("transition_count"), F.col("source"), F.col("target")], 20)
            .alias("top_transitions"),
            _top(activities, [F.desc("event_count"), F.col("activity")]).alias("activities"),
            _top(starts, [F.col("position"), F.col("activity")]).alias("start_end_activities"),
        ),
        "conformance": F.struct(
            split.select("conformant_cases").scalar().alias("conformant_cases"),
            split.select("nonconformant_cases").scalar().alias("nonconformant_cases"),
            _top(
                deviations,
                [F.desc("case_count"), F.col("deviation_type"), F.col("activity")], 20,
            ).alias("deviations"),
        ),
        "performance": F.struct(
            _top(bottlenecks, [F.desc("bottleneck_score"), F.col("activity")], 12)
            .alias("top_bottlenecks"),
            _top(rework_table, [F.desc("repeat_events"), F.col("activity")], 12).alias("rework"),
            _top(
                workload,
                [F.desc("processing_hours"), F.col("resource_id"), F.col("resource_role")], 15,
            ).alias("resource_workload"),
        ),
        "sla_prediction": F.struct(
            _row(model.metrics).alias("metrics"),
            _top(prediction.risk_distribution(model.scored), [F.col("band_order")])
            .alias("risk_distribution"),
            _top(model.drivers, [F.desc("absolute_importance"), F.col("feature")], 15)
            .alias("top_drivers"),
        ),
        "capacity_simulation": F.struct(
            F.lit("Scenario levers applied to the waits observed in the log.").alias("method"),
            _top(compared, [F.col("catalog_index")]).alias("scenarios"),
            _row(recommendation).alias("recommendation"),
        ),
        "governance": F.struct(*[F.lit(v).alias(k) for k, v in GOVERNANCE.items()]),
    }
    report = spark.range(1).select(
        F.struct(*[c.alias(name) for name, c in sections.items()]).alias("report")
    )
    return Analysis(tables, durable(report))


# --- read-only views of a report ----------------------------------------------------------

SECTIONS = {
    "process_map": "process_discovery",
    "conformance": "conformance",
    "bottlenecks": "performance",
    "sla_risk": "sla_prediction",
    "simulations": "capacity_simulation",
    "governance": "governance",
}


def section(report: DataFrame, name: str) -> DataFrame:
    """One section of the report by its view name, as one row of its fields."""
    return report.select(f"report.{SECTIONS[name]}.*")


def summary(report: DataFrame) -> DataFrame:
    return report.select(
        "report.project", "report.data_quality", "report.kpis",
        F.col("report.capacity_simulation.recommendation").alias("recommendation"),
    )
