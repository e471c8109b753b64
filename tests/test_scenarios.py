from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from helpers import SF, rows
from tracewright.log import ProcessLog
from tracewright.operators import measures, scenarios
from tracewright.plans.queries import ORDER_STAGES
from tracewright.session import durable
from tracewright.sources import adapters

# Published scenario outcomes (cycle, adherence, manual hours) and results
# (cycle reduction, uplift in points, manual hours saved, yearly value, first-year return).
PUBLISHED = [
    ("Baseline", 206.60485365857525, 0.6400462962962963, 7.209916840163028,
     (0.0, 0.0, 0.0, 0.0, 0.0)),
    ("Approval Automation", 200.1196977884623, 0.6632870370370371, 6.278753470205561,
     (0.03138917481982295, 2.3240740740740784, 0.9311633699574671, 539528.384697785,
      4.6792461547135265)),
    ("AP Capacity", 203.0352200933709, 0.652175925925926, 7.1319467428532635,
     (0.017277588120477305, 1.2129629629629712, 0.07797009730976434, 185272.36992843953,
      0.23514913285626352)),
    ("Combined Optimization", 166.4844854670217, 0.7763888888888889, 5.823089272162133,
     (0.1941888947965107, 13.634259259259263, 1.3868275680008946, 2213037.020799549,
      8.83572009244244)),
]


@pytest.fixture(scope="module")
def compared(spark):
    means = spark.createDataFrame(
        [(i, name, cycle, cycle, cycle, sla, manual, 8.4)
         for i, (name, cycle, sla, manual, _) in enumerate(PUBLISHED)],
        "catalog_index int, scenario string, mean_cycle_hours double, median_cycle_hours double,"
        " p90_cycle_hours double, sla_adherence double, manual_hours_per_case double,"
        " throughput_cases_per_8h double",
    )
    return scenarios.compare(means, scenarios.catalog_table(spark)).cache()


def test_published_comparison(compared):
    for row, (_, _, _, _, expected) in zip(compared.orderBy("catalog_index").collect(), PUBLISHED,
                                           strict=True):
        got = (row.cycle_time_reduction_pct, row.sla_adherence_uplift_pp,
               row.manual_hours_saved_per_case, row.estimated_annual_value_usd,
               row.first_year_roi)
        assert got == pytest.approx(expected, rel=1e-9)


def test_recommendation(compared):
    best = rows(scenarios.recommend(compared))[0]
    assert best["recommended_scenario"] == "Combined Optimization"
    assert best["estimated_annual_value_usd"] == 2213037.02
    assert best["first_year_roi"] == 8.8357
    assert rows(scenarios.recommend(compared, by_value=True))[0] == best


def test_scenario_measures(compared):
    table = {r["scenario"]: r for r in rows(measures.scenario_measures(compared))}
    combined = table["Combined Optimization"]
    assert combined["cycle_improvement_vs_baseline"] == pytest.approx(0.1941888947965107)
    assert combined["sla_uplift_vs_baseline_pp"] == pytest.approx(13.634259259259263)
    total = rows(measures.scenario_measures(compared, ()))[0]
    assert total["annual_value"] == pytest.approx(sum(p[4][3] for p in PUBLISHED))
    assert total["annual_value_max"] == pytest.approx(2213037.020799549)


def test_catalog(spark):
    catalog = scenarios.catalog_table(spark)
    assert [r.scenario for r in catalog.orderBy("catalog_index").collect()] == [
        p[0] for p in PUBLISHED
    ]
    stages = {(r["scenario"], r["stage"]): r for r in rows(scenarios.stage_table(catalog))}
    assert stages["Combined Optimization", "Invoice Matched"]["capacity"] == 6
    assert stages["Combined Optimization", "Invoice Matched"]["mean_service_hours"] == (
        pytest.approx(1.55 * 0.82)
    )
    assert stages["Baseline", "Invoice Matched"]["capacity"] == 4


def test_what_if(spark):
    log = ProcessLog(adapters.order_process_events(spark, SF), adapters.ORDER_SORT)
    cases = adapters.order_process_cases(spark, SF)
    outcomes = durable(scenarios.what_if(log, ORDER_STAGES, cases))
    assert outcomes.count() == 4 * log.facts.cases
    targets = {r.case_id: r.sla_target_hours for r in cases.collect()}
    assert all(r.sla_target_hours == targets[r.case_id] for r in outcomes.collect())
    outcomes = scenarios.replicated(outcomes, 4)
    means = scenarios.mean_outcomes(scenarios.replication_outcomes(outcomes, 16))
    table = {r["scenario"]: r for r in rows(scenarios.compare(means, scenarios.catalog_table(spark)))}
    base, combined = table["Baseline"], table["Combined Optimization"]
    assert base["first_year_roi"] == 0
    assert combined["mean_cycle_hours"] < base["mean_cycle_hours"]
    assert combined["sla_adherence"] > base["sla_adherence"]
    assert combined["estimated_annual_value_usd"] > 0


def test_replications_draw_from_all_cases(spark):
    """Weights of mean one, the same for all scenarios of a case, and metrics that count them."""
    outcomes = spark.range(0, 2000, 1, 4).select(
        F.col("id").cast("string").alias("case_id"), (F.col("id") * 1_000_000).alias("arrival_us"),
        F.lit(10.0).alias("sla_target_hours"), F.explode(F.array(F.lit(0), F.lit(1))).alias("catalog_index"),
        ((F.col("id") % 20) * 3_600_000_000).alias("cycle_us"), F.lit(60_000_000).alias("manual_us"),
    ).withColumn("scenario", F.concat(F.lit("s"), F.col("catalog_index").cast("string")))
    drawn = scenarios.replicated(outcomes, 7).collect()
    per = {}
    for r in drawn:
        per.setdefault((r.catalog_index, r.replication), {})[r.case_id] = (r.weight, r.cycle_us)
    assert len(per) == 14
    for (scenario, k), weights in per.items():
        assert weights == per[1 - scenario, k]
        assert 1800 < sum(w for w, _ in weights.values()) < 2200
        assert 1150 < len(weights) < 1380  # 1 - 1/e of the cases are in it
    table = {(r.catalog_index, r.replication): r for r in
             scenarios.replication_outcomes(scenarios.replicated(outcomes, 7)).collect()}
    for key, weights in per.items():
        cycles = sorted(c / 3.6e9 for w, c in weights.values() for _ in range(w))
        row = table[key]
        assert row.cases == len(cycles)
        assert row.mean_cycle_hours == pytest.approx(sum(cycles) / len(cycles))
        assert row.sla_adherence == pytest.approx(1 - sum(c > 10 for c in cycles) / len(cycles))
        place = (len(cycles) - 1) * 0.9
        low, high = cycles[int(place)], cycles[min(int(place) + 1, len(cycles) - 1)]
        assert row.p90_cycle_hours == pytest.approx(low + (high - low) * (place - int(place)))


def test_poisson_weights():
    share = [b - a for a, b in zip((0.0, *scenarios.POISSON_LIMITS), scenarios.POISSON_LIMITS, strict=False)]
    assert sum(k * p for k, p in enumerate(share)) == pytest.approx(1, abs=1e-5)


def test_guards():
    for arguments in ((1, 120), (2, 99), (2, 120, 0)):
        with pytest.raises(ValueError):
            scenarios.guard(*arguments)
    scenarios.guard(2, 100)


def test_draw_and_lognormal(spark):
    mu, sigma = scenarios.lognormal_parameters(F.lit(10.0), F.lit(0.4))
    row = spark.range(1).select(
        mu.alias("mu"), sigma.alias("sigma"), scenarios.target_draw(F.lit(0.17)).alias("a"),
        scenarios.target_draw(F.lit(0.18)).alias("b"), scenarios.target_draw(F.lit(0.9)).alias("c"),
    ).first()
    assert row.mu == pytest.approx(math.log(10 / math.sqrt(1.16)))
    assert row.sigma == pytest.approx(math.sqrt(math.log(1.16)))
    assert (row.a, row.b, row.c) == (120.0, 240.0, 336.0)


def test_weights_drawn_once_per_case(spark):
    """Weights that come with the outcomes are those drawn from the outcomes afterwards."""
    log = ProcessLog(adapters.order_process_events(spark, SF), adapters.ORDER_SORT)
    cases = adapters.order_process_cases(spark, SF)
    later = scenarios.replicated(scenarios.what_if(log, ORDER_STAGES, cases), 7)
    first = scenarios.what_if(log, ORDER_STAGES, cases, replications=7)
    assert first.count() == 4 * log.facts.cases
    first = scenarios.replicated(first, 7)
    assert first.columns == later.columns
    assert first.exceptAll(later).count() == later.exceptAll(first).count() == 0
