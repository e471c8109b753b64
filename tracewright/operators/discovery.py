"""Process discovery: traces, variants, directly-follows graph, activity statistics."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.columns import (
    elapsed_us,
    hours,
    minutes,
    minutes_to_us,
    rate,
    share,
    wide_sum,
)
from tracewright.functions.prefix import global_prefix
from tracewright.functions.quantiles import exact_quantiles
from tracewright.log import ProcessLog
from tracewright.session import broadcast_if_small

_STEP_SEPARATOR = " > "
# Attributes of the waiting (target) event that transitions carry along.
_TARGET_ATTRIBUTES = ("resource_role", "business_unit", "department")


# A variant's label spells out this many steps; the number of all steps and a digest of them tell
# longer traces apart. ``variant_steps`` has every step of every variant.
LABEL_STEPS = 1_000


def case_sequences(log: ProcessLog) -> DataFrame:
    """Every event in its place: ``case_id, position, activity``, for cases of any length."""
    return log.numbered("case_id", "activity")


def trace_arrays(log: ProcessLog, whole: bool = False) -> DataFrame:
    """``case_id, steps`` for the cases that one task can hold, or as ``whole`` for all of them."""
    if log.traces is not None and not whole:
        return log.traces
    event = F.struct(*dict.fromkeys((*log.order, "activity")))
    rows = log.events if whole else log.dealt(log.regular.select("case_id", event.alias("_event")))
    event = event if whole else F.col("_event")
    return rows.groupBy("case_id").agg(
        F.transform(F.sort_array(F.collect_list(event)), lambda e: e["activity"]).alias("steps")
    )


def _step_hashes(position: Column, activity: Column) -> list[Column]:
    """128 bits of a step at its place. XOR over the steps is the digest of the trace: it tells
    orders apart, and partial digests combine in any order."""
    step = (position.cast("bigint"), activity)
    return [F.xxhash64(*step), F.xxhash64(F.lit("second"), *step)]


def _keyed_traces(log: ProcessLog) -> DataFrame:
    """``case_id, activity_count, head, d1, d2``: what tells the traces of two cases apart.

    ``head`` are the first ``LABEL_STEPS`` activities; the digest is null where they are all.
    A case in segments is never gathered: its digest is folded on the map side, and only
    the head is collected.
    """
    beyond = F.col("activity_count") > LABEL_STEPS

    def folded(i):
        hashes = F.transform("steps", lambda a, at: _step_hashes(at + 1, a)[i])
        return F.aggregate(hashes, F.lit(0).cast("bigint"), lambda x, y: x.bitwiseXOR(y))

    rows = trace_arrays(log).withColumn("activity_count", F.size("steps").cast("bigint")).select(
        "case_id", "activity_count", F.slice("steps", 1, LABEL_STEPS).alias("head"),
        *[F.when(beyond, folded(i)).alias(f"d{i + 1}") for i in (0, 1)],
    )
    if not log.has_long_cases:
        return rows
    step = F.struct("position", "activity")
    first, second = _step_hashes(F.col("position"), F.col("activity"))
    folds = log.segments.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("activity_count"),
        F.sort_array(F.collect_list(F.when(F.col("position") <= LABEL_STEPS, step))).alias("head"),
        F.bit_xor(first).alias("d1"), F.bit_xor(second).alias("d2"),
    )
    return rows.unionByName(folds.select(
        "case_id", "activity_count", F.transform("head", lambda e: e["activity"]).alias("head"),
        *[F.when(beyond, F.col(d)).alias(d) for d in ("d1", "d2")],
    ))


def _label() -> Column:
    head = F.array_join("head", _STEP_SEPARATOR)
    digest = F.concat(*[F.lpad(F.lower(F.hex(d)), 16, "0") for d in ("d1", "d2")])
    rest = F.concat(
        F.lit(_STEP_SEPARATOR + "... ["), F.col("activity_count").cast("string"),
        F.lit(" steps, "), digest, F.lit("]"),
    )
    return F.concat(head, F.when(F.col("d1").isNull(), "").otherwise(rest)).alias("variant")


def case_variants(log: ProcessLog) -> DataFrame:
    """``case_id, activity_count, variant``: the label of each case's trace."""
    return _keyed_traces(log).select("case_id", "activity_count", _label())


def _grouped_traces(log: ProcessLog) -> DataFrame:
    """Distinct traces, grouped on what tells them apart and not on the label."""
    return _keyed_traces(log).groupBy("activity_count", "head", "d1", "d2").agg(
        F.count(F.lit(1)).alias("case_count"), F.min("case_id").alias("first_case")
    ).select(_label(), "activity_count", "case_count", "first_case")


def variant_counts(log: ProcessLog) -> DataFrame:
    """Distinct traces with case counts, unranked."""
    return _grouped_traces(log).drop("first_case")


def variant_steps(log: ProcessLog) -> DataFrame:
    """``variant, position, activity``: all steps of each variant, read from its first case."""
    picked = _grouped_traces(log).select("variant", F.col("first_case").alias("case_id"))
    return case_sequences(log).join(picked, "case_id").select("variant", "position", "activity")


def variants(log: ProcessLog) -> DataFrame:
    """Ranked variants with their share of cases and the running share by rank."""
    ranked = global_prefix(
        variant_counts(log),
        order=[F.col("case_count").desc(), F.col("variant").asc()],
        sums=["case_count"],
        rank="variant_rank",
    )
    return ranked.select(
        F.col("variant_rank").cast("bigint").alias("variant_rank"),
        "variant",
        "activity_count",
        "case_count",
        share(F.col("case_count"), F.col("total_case_count")).alias("case_share"),
        share(F.col("cum_case_count"), F.col("total_case_count")).alias("cumulative_share"),
    )


def transitions(log: ProcessLog) -> DataFrame:
    """One row per non-first event: the event, its predecessor and the wait between them."""
    kept = [c for c in _TARGET_ATTRIBUTES if c in log.events.columns]
    linked = log.linked(
        "case_id", "activity", "timestamp", *kept, previous=("activity", "timestamp")
    )
    return linked.where(F.col("before").isNotNull()).select(
        "case_id",
        F.col("before.activity").alias("previous_activity"),
        "activity",
        elapsed_us(F.col("before.timestamp"), F.col("timestamp")).alias("wait_us"),
        *kept,
    )


def transition_waits(log: ProcessLog) -> DataFrame:
    steps = transitions(log)
    return steps.select(
        "case_id", "previous_activity", "activity",
        hours(F.col("wait_us")).alias("wait_hours"),
        *[c for c in _TARGET_ATTRIBUTES if c in steps.columns],
    )


def directly_follows(log: ProcessLog, steps: DataFrame | None = None) -> DataFrame:
    """Edges with count and exact wait statistics.

    ``case_coverage`` is transitions over cases and passes 1 where a case repeats an edge.
    ``steps`` takes transitions that were already materialised, here and in the operators
    below.
    """
    edges = exact_quantiles(
        steps or transitions(log), ["previous_activity", "activity"], "wait_us",
        {"median": 0.5, "p90": 0.9}, max_groups=log.activity_count**2,
    )
    return edges.select(
        F.col("previous_activity").alias("source"),
        F.col("activity").alias("target"),
        F.col("n").alias("transition_count"),
        hours(share(F.col("total"), F.col("n"))).alias("mean_wait_hours"),
        hours(F.col("median")).alias("median_wait_hours"),
        hours(F.col("p90")).alias("p90_wait_hours"),
        share(F.col("n"), F.lit(log.facts.cases)).alias("case_coverage"),
    )


def directly_follows_view(log: ProcessLog, steps: DataFrame | None = None) -> DataFrame:
    """The reporting view of the edges: count and mean wait to two decimals."""
    return (steps or transitions(log)).groupBy(
        F.col("previous_activity").alias("source_activity"),
        F.col("activity").alias("target_activity"),
    ).agg(
        F.count(F.lit(1)).alias("transition_count"),
        F.round(hours(share(wide_sum(F.col("wait_us")), F.count(F.lit(1)))), 2)
        .alias("mean_wait_hours"),
    )


def top_wait_transitions(view: DataFrame, limit: int = 15) -> DataFrame:
    """Edges with the most waiting in total; ties go by name."""
    return view.orderBy(
        (F.col("mean_wait_hours") * F.col("transition_count")).desc(),
        "source_activity", "target_activity",
    ).limit(limit)


def activity_summary(log: ProcessLog) -> DataFrame:
    touch = log.events.select(
        "case_id", "activity", "automated",
        minutes_to_us(F.col("processing_minutes")).alias("touch_us"),
    )
    counted = touch.groupBy("activity").agg(
        F.count_distinct("case_id").alias("case_count"),
        F.count(F.lit(1)).alias("event_count"),
        rate(F.col("automated")).alias("automation_rate"),
    )
    timing = exact_quantiles(
        touch, ["activity"], "touch_us", {"median": 0.5}, max_groups=log.activity_count
    )
    return counted.join(timing, "activity", "left").select(
        "activity",
        "event_count",
        "case_count",
        "automation_rate",
        minutes(share(F.col("total"), F.col("n"))).alias("mean_processing_minutes"),
        minutes(F.col("median")).alias("median_processing_minutes"),
        share(F.col("case_count"), F.lit(log.facts.cases)).alias("case_coverage"),
    )


def activity_view(events: DataFrame) -> DataFrame:
    """The reporting view of the activities, rounded."""
    touch = minutes_to_us(F.col("processing_minutes"))
    return events.groupBy("activity").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("case_id").alias("case_count"),
        F.round(minutes(share(wide_sum(touch), F.count(touch))), 2)
        .alias("mean_processing_minutes"),
        F.round(rate(F.col("automated")), 4).alias("automation_rate"),
    )


def start_end_activities(log: ProcessLog) -> DataFrame:
    """``position (start|end), activity, case_count`` by map-side combined min/max, or from traces that
    are written down."""
    order = F.struct(*log.order)

    def combined(events):
        return events.groupBy("case_id").agg(
            F.min_by("activity", order).alias("start"), F.max_by("activity", order).alias("end"))

    if log.traces is None:
        ends = combined(log.events)
    else:
        ends = log.traces.select(
            "case_id", F.get("steps", F.lit(0)).alias("start"),
            F.get("steps", F.size("steps") - 1).alias("end"))
        if log.has_long_cases:
            ends = ends.unionByName(combined(log.long_events))
    return (
        ends.select(F.explode(F.create_map(F.lit("start"), "start", F.lit("end"), "end"))
                    .alias("position", "activity"))
        .groupBy("position", "activity").agg(F.count(F.lit(1)).alias("case_count"))
    )


def sample_log(log: ProcessLog, sample_cases: int = 2_000) -> ProcessLog:
    """The first cases in sorted id order: the deterministic sample of the miner bridge."""
    ids = log.events.select("case_id").distinct().orderBy("case_id").limit(sample_cases)
    picked = log.events.join(
        broadcast_if_small(ids, sample_cases), "case_id", "left_semi"
    )
    return replace(log, events=picked)


def sample_edge_count(log: ProcessLog, sample_cases: int = 2_000) -> DataFrame:
    """One row: cases in the sample and edges of its directly-follows graph."""
    sample = sample_log(log, sample_cases)
    edges = transitions(sample).select("previous_activity", "activity").distinct()
    cases = sample.events.select(F.count_distinct("case_id"))
    return edges.agg(F.count(F.lit(1)).alias("dfg_edges")).select(
        cases.scalar().alias("sample_cases"), "dfg_edges"
    )


def log_format(events: DataFrame) -> DataFrame:
    """Canonical columns under the names process-mining tools expect."""
    return events.select(
        F.col("case_id").alias("case:concept:name"),
        F.col("activity").alias("concept:name"),
        F.col("timestamp").alias("time:timestamp"),
        "resource_id",
    )


def edge_counts(log: ProcessLog, steps: DataFrame | None = None) -> DataFrame:
    return (steps or transitions(log)).groupBy(
        F.col("previous_activity").alias("source"), F.col("activity").alias("target")
    ).agg(F.count(F.lit(1)).alias("transition_count"))


def footprint(edges: DataFrame) -> DataFrame:
    """Relation of each connected ordered pair: causal, reverse or parallel.

    Pairs that never follow each other (``#``) are all the others and are not listed.
    """
    forward = edges.select("source", "target", F.col("transition_count").alias("forward"))
    backward = edges.select(
        F.col("target").alias("source"), F.col("source").alias("target"),
        F.col("transition_count").alias("backward"),
    )
    both = forward.join(backward, ["source", "target"], "full_outer")
    relation = (
        F.when(F.col("backward").isNull(), "->")
        .when(F.col("forward").isNull(), "<-")
        .otherwise("||")
    )
    return both.select(
        "source", "target",
        F.coalesce("forward", F.lit(0)).alias("forward_count"),
        F.coalesce("backward", F.lit(0)).alias("backward_count"),
        relation.alias("relation"),
    )


def path_edges(spark, path) -> DataFrame:
    """Edges of a designed path, e.g. the ideal process."""
    pairs = list(dict.fromkeys(zip(path[:-1], path[1:], strict=True)))
    return spark.createDataFrame(pairs, "source string, target string")


def model_edge_check(edges: DataFrame, model: DataFrame) -> DataFrame:
    """Designed edges against observed ones: ``both``, ``model_only`` or ``log_only``."""
    expected = model.select("source", "target", F.lit(True).alias("in_model"))
    joined = edges.join(expected, ["source", "target"], "full_outer")
    status = (
        F.when(F.col("in_model").isNull(), "log_only")
        .when(F.col("transition_count").isNull(), "model_only")
        .otherwise("both")
    )
    return joined.select(
        "source", "target",
        F.coalesce("transition_count", F.lit(0)).alias("transition_count"),
        status.alias("status"),
    )


def label_drift(current: DataFrame, prior: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Share of each label now and before, for every column in ``columns``."""

    def shares(df, column, name):
        counts = df.groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("_n"))
        # One row per label.
        total = F.sum("_n").over(Window.partitionBy())
        return counts.select("label", share(F.col("_n"), total).alias(name))

    parts = []
    for column in columns:
        joined = shares(current, column, "now").join(
            shares(prior, column, "then"), "label", "full_outer"
        )
        now = F.coalesce("now", F.lit(0.0))
        then = F.coalesce("then", F.lit(0.0))
        parts.append(joined.select(
            F.lit(column).alias("dimension"), "label",
            now.alias("current_share"), then.alias("prior_share"),
            (now - then).alias("share_delta"),
        ))
    return reduce(DataFrame.unionByName, parts)
