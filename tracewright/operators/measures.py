"""Semantic-layer measures under slicers: grouped, rolled up, cubed or by grouping sets.

Case ids are unique in a case table that passed its contract, so distinct case counts are
row counts here, which keeps every additive measure a map-side combined aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.columns import hours, hours_to_us, share, wide_sum
from tracewright.functions.quantiles import exact_quantiles

# The dashboard's slicers.
SLICERS = ("business_unit", "country", "vendor_tier", "priority")


# Columns of the five import tables of the semantic layer.
IMPORT_TABLES = {
    "case_performance": (
        "case_id string, business_unit string, vendor_tier string, amount_usd double, "
        "cycle_time_hours double, sla_breached boolean, fitness double, conformant boolean, "
        "automation_rate double"
    ),
    "bottlenecks": (
        "activity string, total_wait_hours double, p90_wait_hours double, "
        "bottleneck_score double"
    ),
    "variants": "variant_rank bigint, variant string, case_count bigint, case_share double",
    "risk_predictions": (
        "case_id string, risk_score double, risk_band string, predicted_breach boolean"
    ),
    "simulation_scenarios": (
        "scenario string, mean_cycle_hours double, sla_adherence double, "
        "estimated_annual_value_usd double, first_year_roi double"
    ),
}


def import_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The result tables the semantic layer imports, cut to its columns and types."""
    out = {}
    for name, ddl in IMPORT_TABLES.items():
        columns = [part.strip().split(" ") for part in ddl.split(",")]
        out[name] = tables[name].select(*[F.col(c).cast(t).alias(c) for c, t in columns])
    return out


def rollup_sets(slicers: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(slicers[:n]) for n in range(len(slicers), -1, -1)]


def cube_sets(slicers: Sequence[str]) -> list[tuple[str, ...]]:
    return [s for n in range(len(slicers), -1, -1) for s in combinations(slicers, n)]


def _case_aggregates(columns: Sequence[str]) -> list:
    breached = F.col("sla_breached")
    parts = [
        F.count(F.lit(1)).alias("cases"),
        F.sum(F.col("amount_usd").cast("decimal(14,2)")).cast("double").alias("total_spend"),
        hours(share(wide_sum(F.col("cycle_us")), F.count("cycle_us")))
        .alias("average_cycle_hours"),
        F.count_if(breached).alias("sla_breached_cases"),
    ]
    if "conformant" in columns:
        parts += [
            F.count_if("conformant").alias("conformant_cases"),
            F.avg("fitness").alias("conformance_fitness"),
        ]
    if "automation_rate" in columns:
        parts.append(F.avg("automation_rate").alias("automation_share"))
    return parts


def _finish(table: DataFrame, keys: Sequence[str], median: DataFrame) -> DataFrame:
    """Ratio measures, and the median joined null-safe on the grouping keys."""
    out = table.withColumns({
        "average_spend_per_case": share(F.col("total_spend"), F.col("cases")),
        "sla_adherence": 1 - share(F.col("sla_breached_cases"), F.col("cases")),
    })
    if "conformant_cases" in table.columns:
        out = out.withColumn("straight_through", share(F.col("conformant_cases"), F.col("cases")))
    if not keys:
        return out.withColumn("median_cycle_hours", hours(median.select("median").scalar()))
    left, right = out.alias("l"), median.alias("r")
    match = [F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}")) for key in keys]
    return left.join(right, match).select(
        "l.*", hours(F.col("r.median")).alias("median_cycle_hours")
    )


def case_measures(cases: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Measures of the case table, one row per combination of ``by``."""
    base = cases.withColumn("cycle_us", hours_to_us(F.col("cycle_time_hours")))
    table = base.groupBy(*by).agg(*_case_aggregates(cases.columns))
    median = exact_quantiles(base, by, "cycle_us", {"median": 0.5})
    return _finish(table, by, median)


def case_measures_sets(
    cases: DataFrame, by: Sequence[str], sets: Sequence[Sequence[str]]
) -> DataFrame:
    """The same measures for several grouping sets at once (rollup, cube, any list).

    ``level`` has one bit per slicer, first slicer highest, set where the slicer is summed
    over. The median's rows are multiplied by the sets only ahead of a map-side combined
    count, so the shuffles stay at the size of the cells.
    """
    base = cases.withColumn("cycle_us", hours_to_us(F.col("cycle_time_hours")))
    names = [F.col(c) for c in by]
    table = base.groupingSets([[F.col(c) for c in s] for s in sets], *names).agg(
        F.grouping_id().cast("int").alias("level"), *_case_aggregates(cases.columns)
    )

    def level(kept):
        return sum(1 << (len(by) - 1 - i) for i, c in enumerate(by) if c not in kept)

    masks = F.array(*[
        F.struct(
            F.lit(level(s)).alias("level"),
            *[(F.col(c) if c in s else F.lit(None).cast("string")).alias(c) for c in by],
        )
        for s in sets
    ])
    spread = base.select("cycle_us", F.inline(masks))
    keys = ["level", *by]
    return _finish(table, keys, exact_quantiles(spread, keys, "cycle_us", {"median": 0.5}))


def risk_measures(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    table = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("scored_cases"),
        F.count_if(F.col("risk_band").isin("High", "Critical")).alias("high_risk_cases"),
        F.avg("risk_score").alias("average_risk_score"),
    )
    return table.withColumn(
        "high_risk_share", share(F.col("high_risk_cases"), F.col("scored_cases"))
    )


def process_measures(bottlenecks: DataFrame, variants: DataFrame) -> DataFrame:
    """Measures over the small result tables: waiting, top bottleneck and top variant."""
    top = variants.agg(
        F.max("case_count").alias("cases"), F.max("case_share").alias("share")
    )
    return bottlenecks.agg(
        F.sum("total_wait_hours").alias("total_wait_hours"),
        F.max("bottleneck_score").alias("top_bottleneck_score"),
    ).select(
        "total_wait_hours", "top_bottleneck_score",
        top.select("cases").scalar().alias("top_variant_cases"),
        top.select("share").scalar().alias("top_variant_share"),
    )


def scenario_measures(compared: DataFrame, by: Sequence[str] = ("scenario",)) -> DataFrame:
    """Scenario measures and their change against the row named Baseline.

    The baseline filter replaces the scenario filter, so every row sees the same baseline.
    ``annual_value`` sums and ``annual_value_max`` takes the maximum: two published variants
    of one measure.
    """
    everywhere = Window.partitionBy()  # one row per scenario
    base = F.col("scenario") == "Baseline"
    cycle = F.avg(F.when(base, F.col("mean_cycle_hours"))).over(everywhere)
    adherence = F.avg(F.when(base, F.col("sla_adherence"))).over(everywhere)
    rows = compared.withColumns({"_base_cycle": cycle, "_base_sla": adherence})
    table = rows.groupBy(*by).agg(
        F.avg("mean_cycle_hours").alias("scenario_cycle_hours"),
        F.avg("sla_adherence").alias("scenario_sla"),
        F.sum("estimated_annual_value_usd").alias("annual_value"),
        F.max("estimated_annual_value_usd").alias("annual_value_max"),
        F.max("first_year_roi").alias("first_year_roi"),
        F.max("_base_cycle").alias("_base_cycle"),
        F.max("_base_sla").alias("_base_sla"),
    )
    return table.select(
        *by, "scenario_cycle_hours", "scenario_sla", "annual_value", "annual_value_max",
        "first_year_roi",
        (1 - share(F.col("scenario_cycle_hours"), F.col("_base_cycle")))
        .alias("cycle_improvement_vs_baseline"),
        (100 * (F.col("scenario_sla") - F.col("_base_sla"))).alias("sla_uplift_vs_baseline_pp"),
    )


