"""Cycle time, bottlenecks, rework, workload, SLA views and the KPI row."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.columns import (
    elapsed_us,
    hours,
    hours_to_us,
    minutes_to_us,
    rate,
    share,
    wide_sum,
)
from tracewright.functions.quantiles import exact_quantiles
from tracewright.log import ProcessLog
from tracewright.model import ANNUAL_CASE_VOLUME
from tracewright.operators.discovery import transitions
from tracewright.session import durable

# Weights of the bottleneck score.
SCORE_WEIGHTS = {"total": 0.55, "p90": 0.30, "coverage": 0.15}


def bottlenecks(log: ProcessLog, steps: DataFrame | None = None) -> DataFrame:
    """Waiting-time exposure by target activity, with a score between 0 and 1."""
    waits = steps or transitions(log)
    timing = exact_quantiles(
        waits, ["activity"], "wait_us", {"median": 0.5, "p90": 0.9, "p95": 0.95},
        max_groups=log.activity_count,
    )
    # Already partitioned by case, so the distinct pairs need no further shuffle.
    reach = waits.select("case_id", "activity").distinct().groupBy("activity").agg(
        F.count(F.lit(1)).alias("case_count")
    )
    table = timing.join(reach, "activity").select(
        "activity",
        "case_count",
        F.col("n").alias("transition_count"),
        hours(F.col("total")).alias("total_wait_hours"),
        hours(share(F.col("total"), F.col("n"))).alias("mean_wait_hours"),
        *[hours(F.col(q)).alias(f"{q}_wait_hours") for q in ("median", "p90", "p95")],
        share(F.col("case_count"), F.lit(log.facts.cases)).alias("case_coverage"),
    )
    return score_bottlenecks(table)


def score_bottlenecks(table: DataFrame) -> DataFrame:
    """Add the score: weighted total wait, p90 wait (both against the largest) and reach."""
    everyone = Window.partitionBy()  # one row per activity

    def relative(column):
        return share(F.col(column), F.max(column).over(everyone))

    score = (
        SCORE_WEIGHTS["total"] * relative("total_wait_hours")
        + SCORE_WEIGHTS["p90"] * relative("p90_wait_hours")
        + SCORE_WEIGHTS["coverage"] * F.col("case_coverage")
    )
    return table.withColumn("bottleneck_score", score)


def case_performance(events: DataFrame) -> DataFrame:
    """Cycle, touch and wait time, rework and automation per case, in one aggregate."""
    grouped = events.groupBy("case_id").agg(
        F.min("timestamp").alias("created_at"),
        F.max("timestamp").alias("completed_at"),
        F.count(F.lit(1)).alias("event_count"),
        # Bounded by the number of activity labels.
        F.size(F.collect_set("activity")).cast("bigint").alias("unique_activity_count"),
        wide_sum(minutes_to_us(F.col("processing_minutes"))).alias("_touch_us"),
        F.count_if("automated").alias("automated_event_count"),
    )
    cycle = hours(elapsed_us(F.col("created_at"), F.col("completed_at")))
    touch = hours(F.col("_touch_us"))
    zero = F.lit(0.0)
    return grouped.select(
        "case_id", "created_at", "completed_at", "event_count", "unique_activity_count",
        (F.col("_touch_us").cast("double") / 60e6).alias("processing_minutes"),
        "automated_event_count",
        cycle.alias("cycle_time_hours"),
        touch.alias("touch_time_hours"),
        F.greatest(zero, cycle - touch).alias("estimated_wait_hours"),
        F.greatest(F.lit(0), F.col("event_count") - F.col("unique_activity_count"))
        .alias("rework_event_count"),
        share(F.col("automated_event_count"), F.col("event_count")).alias("automation_rate"),
    )


def rework_summary(events: DataFrame) -> DataFrame:
    """Activities that occur more than once in a case."""
    per_case = events.groupBy("case_id", "activity").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_case.where("n > 1").groupBy("activity")
        .agg(
            F.count(F.lit(1)).alias("affected_cases"),
            F.sum(F.col("n") - 1).alias("repeat_events"),
            F.avg("n").alias("mean_occurrences"),
        )
    )


def resource_workload(events: DataFrame | ProcessLog) -> DataFrame:
    """Volume, hours and share of all hours by resource; rows without a resource drop out.

    Counted by resource and case first, where a log is dealt by case, so that a task holds the
    pairs of its own events; long cases combine on the map side. Written down once: the
    shares need all hours.
    """
    log = events if isinstance(events, ProcessLog) else ProcessLog(events)
    known = F.col("resource_id").isNotNull() & F.col("resource_role").isNotNull()
    keys = ["resource_id", "resource_role"]

    def by_case(rows):
        return rows.groupBy(*keys, "case_id").agg(
            F.count(F.lit(1)).alias("events"),
            wide_sum(minutes_to_us(F.col("processing_minutes"))).alias("us"),
            F.count_if("automated").alias("automated"), F.count("automated").alias("told"))

    used = (*keys, "case_id", "processing_minutes", "automated")
    pairs = by_case(log.dealt(log.regular.where(known).select(*used)))
    if log.has_long_cases:
        pairs = pairs.unionByName(by_case(log.long_events.where(known).select(*used)))
    table = durable(pairs.groupBy(*keys).agg(
        F.sum("events").alias("event_count"), F.count("case_id").alias("case_count"),
        F.sum("us").alias("_us"), share(F.sum("automated"), F.sum("told")).alias("automated_rate")))
    total = table.select(F.sum("_us")).scalar()
    return table.select(
        *keys, "event_count", "case_count",
        hours(F.col("_us")).alias("processing_hours"),
        "automated_rate",
        F.coalesce(share(F.col("_us"), total), F.lit(0.0)).alias("workload_share"),
    )


def sla_consumption(cases: DataFrame) -> DataFrame:
    """Case view with the part of the SLA target that the cycle used."""
    used = share(F.col("cycle_time_hours"), F.col("sla_target_hours"))
    return cases.select(
        "case_id", "business_unit", "department", "vendor_id", "vendor_tier", "priority",
        "amount_usd", "variant_ground_truth", "event_count", "rework_count",
        "cycle_time_hours", "sla_target_hours", "sla_breached",
        F.round(used, 4).alias("sla_consumption_ratio"),
    )


def _adherence():
    return F.avg(F.when(F.col("sla_breached"), 0.0).otherwise(1.0))


def sla_monthly(cases: DataFrame) -> DataFrame:
    keyed = cases.select(
        F.date_trunc("month", "completed_at").alias("completed_month"),
        "business_unit", "priority", "sla_breached",
        hours_to_us(F.col("cycle_time_hours")).alias("cycle_us"),
    )
    keys = ["completed_month", "business_unit", "priority"]
    timing = exact_quantiles(keyed, keys, "cycle_us", {"p90": 0.9})
    counted = keyed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("case_count"), F.round(_adherence(), 4).alias("sla_adherence")
    )
    return counted.join(timing, keys).select(
        *keys, "case_count", "sla_adherence",
        F.round(hours(share(F.col("total"), F.col("n"))), 2).alias("mean_cycle_hours"),
        F.round(hours(F.col("p90")), 2).alias("p90_cycle_hours"),
    )


def bu_sla_gap(cases: DataFrame) -> DataFrame:
    cycle = hours_to_us(F.col("cycle_time_hours"))
    return (
        cases.groupBy("business_unit").agg(
            F.count(F.lit(1)).alias("cases"),
            F.round(_adherence(), 4).alias("sla_adherence"),
            F.round(hours(share(wide_sum(cycle), F.count(F.lit(1)))), 2)
            .alias("mean_cycle_hours"),
        ).orderBy("sla_adherence", "business_unit")
    )


def rework_concentration(cases: DataFrame) -> DataFrame:
    return (
        cases.where("rework_count > 0").groupBy("variant_ground_truth").agg(
            F.count(F.lit(1)).alias("cases"), F.sum("rework_count").alias("repeat_events")
        ).orderBy(F.desc("repeat_events"), "variant_ground_truth")
    )


def enrich_cases(cases: DataFrame, conformance: DataFrame, performance: DataFrame) -> DataFrame:
    """Cases with fitness, conformance, touch, wait and automation; all joins by case id."""
    return cases.join(
        conformance.select("case_id", "fitness", "conformant"), "case_id", "left"
    ).join(
        performance.select(
            "case_id", "touch_time_hours", "estimated_wait_hours", "automation_rate"
        ), "case_id", "left",
    )


def kpis(
    events: DataFrame, cases: DataFrame, conformance: DataFrame, performance: DataFrame
) -> DataFrame:
    """The KPI row. Each part is one global aggregate, put together as scalar subqueries."""
    cycle = cases.select(hours_to_us(F.col("cycle_time_hours")).alias("cycle_us"))
    timing = exact_quantiles(
        cycle, [], "cycle_us", {"median": 0.5, "p90": 0.9, "p95": 0.95}, max_groups=1
    )
    outcome = cases.agg(
        _adherence().alias("sla_adherence"),
        rate(F.col("rework_count") > 0).alias("rework_case_rate"),
    )
    path = conformance.agg(
        rate(F.col("conformant")).alias("straight_through_rate"),
        F.avg("fitness").alias("mean_conformance_fitness"),
    )
    wait = performance.agg(share(
        F.sum("estimated_wait_hours"), F.greatest(F.sum("cycle_time_hours"), F.lit(1.0))
    ))
    automation = events.agg(rate(F.col("automated")))

    def part(frame, column):
        return frame.select(column).scalar()

    return timing.select(
        *[F.round(hours(F.col(q)), 2).alias(f"{q}_cycle_hours") for q in ("median", "p90", "p95")],
        F.round(part(outcome, "sla_adherence"), 4).alias("sla_adherence"),
        F.round(part(path, "straight_through_rate"), 4).alias("straight_through_rate"),
        F.round(part(path, "mean_conformance_fitness"), 4).alias("mean_conformance_fitness"),
        F.round(part(outcome, "rework_case_rate"), 4).alias("rework_case_rate"),
        F.round(automation.scalar(), 4).alias("automation_event_rate"),
        F.round(wait.scalar(), 4).alias("wait_time_share"),
        F.lit(ANNUAL_CASE_VOLUME).alias("annualized_case_volume"),
    )


def case_explorer(
    cases: DataFrame, conformance: DataFrame, variants: DataFrame | None = None,
    scored: DataFrame | None = None,
) -> DataFrame:
    """Searchable case list: cycle and SLA, conformance, and where given variant and risk.

    ``variants`` maps ``case_id`` to a variant label, ``scored`` holds the holdout's scores.
    Every join is by case id.
    """
    out = cases.select(
        "case_id", "business_unit", "country", "vendor_tier", "priority", "amount_usd",
        "cycle_time_hours", "sla_target_hours", "sla_breached",
    ).join(
        conformance.select("case_id", "fitness", "conformant", "edit_distance"), "case_id", "left"
    )
    if variants is not None:
        out = out.join(variants.select("case_id", "variant"), "case_id", "left")
    if scored is not None:
        out = out.join(scored.select("case_id", "risk_score", "risk_band"), "case_id", "left")
    return out


def case_timeline(log: ProcessLog, chosen: DataFrame) -> DataFrame:
    """Events of the chosen cases in order, each with its place in the case."""
    events = log.events.join(chosen.select("case_id"), "case_id", "left_semi")
    picked = replace(log, events=events)
    return picked.numbered(
        "case_id", "activity", "timestamp", "resource_id", "processing_minutes"
    )


def segment_sla(
    log: ProcessLog, cases: DataFrame, steps: DataFrame | None = None
) -> DataFrame:
    """Adherence and waiting by business unit, priority, tier, activity and role.

    Waits are summed per case, activity and role before the join, so a long case
    reaches the join as a handful of rows.
    """
    touched = (steps or transitions(log)).groupBy("case_id", "activity", "resource_role").agg(
        wide_sum(F.col("wait_us")).alias("wait_us")
    )
    dims = ("business_unit", "priority", "vendor_tier", "activity", "resource_role")
    joined = cases.select("case_id", "sla_breached", *dims[:3]).join(touched, "case_id", "left")
    pairs = F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).alias("member")) for d in dims
    ])
    rows = joined.select("case_id", "sla_breached", "wait_us", F.inline(pairs))
    per_case = rows.where(F.col("member").isNotNull()).groupBy(
        "case_id", "dimension", "member"
    ).agg(
        F.max("sla_breached").alias("sla_breached"),
        F.sum("wait_us").alias("wait_us"),
    )
    return per_case.groupBy("dimension", "member").agg(
        F.count(F.lit(1)).alias("case_count"),
        _adherence().alias("sla_adherence"),
        hours(F.coalesce(F.sum("wait_us"), F.lit(0))).alias("total_wait_hours"),
    )


def dominant_transitions(
    log: ProcessLog, chosen: DataFrame, steps: DataFrame | None = None
) -> DataFrame:
    """Edges inside the chosen cases (e.g. the high-risk ones) with count and total wait."""
    per_case = (steps or transitions(log)).groupBy("case_id", "previous_activity", "activity").agg(
        F.count(F.lit(1)).alias("n"), wide_sum(F.col("wait_us")).alias("wait_us")
    )
    return (
        per_case.join(chosen.select("case_id"), "case_id", "left_semi")
        .groupBy(F.col("previous_activity").alias("source"), F.col("activity").alias("target"))
        .agg(
            F.sum("n").alias("transition_count"),
            hours(F.sum("wait_us")).alias("total_wait_hours"),
        )
    )
