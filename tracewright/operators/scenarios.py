"""What-if scenarios on the observed log, and the comparison tables around them."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.functions.columns import (
    HOUR_US,
    elapsed_us,
    hours,
    minutes_to_us,
    share,
    whole,
    wide_sum,
)
from tracewright.functions.draws import digest, drawn, drawn_below, settled, uniform
from tracewright.functions.quantiles import by_lane, exact_quantiles, lane_quantiles
from tracewright.log import ProcessLog
from tracewright.model import ANNUAL_CASE_VOLUME
from tracewright.session import durable

# Stage name, seats, mean service hours of the observed staffing.
BASE_STAGES = (
    ("Manager Approval", 7, 1.15),
    ("Procurement Review", 6, 1.45),
    ("Purchase Order Created", 5, 0.95),
    ("Goods Received", 7, 0.80),
    ("Invoice Matched", 4, 1.55),
    ("Payment Authorized", 3, 1.05),
)
STAGE_VARIABILITY = 0.45
# Value in USD per hour of delay, manual hour and avoided breach.
DELAY_HOUR_USD, MANUAL_HOUR_USD, BREACH_USD = 5.5, 32.0, 85.0
# SLA target mix by upper limit of a uniform draw.
TARGET_MIX = ((0.18, 120.0), (0.86, 240.0), (1.0, 336.0))


@dataclass(frozen=True)
class Scenario:
    """Changes against the observed staffing, by stage name."""

    name: str
    description: str
    seats: dict[str, int]
    service_factor: dict[str, float]
    lead_time_factor: float = 1.0
    rework_probability: float = 0.16
    investment_usd: float = 0.0


# The governed scenario catalog, baseline first.
CATALOG = (
    Scenario(
        "Baseline",
        "Observed staffing, manual approval, and invoice rework assumptions.",
        {}, {},
    ),
    Scenario(
        "Approval Automation",
        "Rules-based low-risk approvals and faster purchase-order preparation.",
        {}, {"Manager Approval": 0.58, "Purchase Order Created": 0.58},
        lead_time_factor=0.97, rework_probability=0.13, investment_usd=95_000.0,
    ),
    Scenario(
        "AP Capacity",
        "Two additional invoice-match seats and one treasury seat.",
        {"Invoice Matched": 6, "Payment Authorized": 4}, {},
        rework_probability=0.11, investment_usd=150_000.0,
    ),
    Scenario(
        "Combined Optimization",
        "Approval automation, AP capacity, and supplier lead-time intervention.",
        {"Invoice Matched": 6, "Payment Authorized": 4},
        {"Manager Approval": 0.55, "Purchase Order Created": 0.55, "Invoice Matched": 0.82},
        lead_time_factor=0.82, rework_probability=0.07, investment_usd=225_000.0,
    ),
)

_STAGE = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("capacity", T.IntegerType()),
    T.StructField("mean_service_hours", T.DoubleType()),
    T.StructField("variability", T.DoubleType()),
])
CATALOG_SCHEMA = T.StructType([
    T.StructField("catalog_index", T.IntegerType()),
    T.StructField("scenario", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("stages", T.ArrayType(_STAGE)),
    T.StructField("external_lead_time_multiplier", T.DoubleType()),
    T.StructField("invoice_rework_probability", T.DoubleType()),
    T.StructField("one_time_investment_usd", T.DoubleType()),
])


def catalog_table(spark: SparkSession, catalog: Sequence[Scenario] = CATALOG) -> DataFrame:
    """The catalog as a dimension, one row per scenario with its stages nested."""
    rows = [
        (
            i, s.name, s.description,
            [
                (name, s.seats.get(name, seats), mean * s.service_factor.get(name, 1.0),
                 STAGE_VARIABILITY)
                for name, seats, mean in BASE_STAGES
            ],
            s.lead_time_factor, s.rework_probability, s.investment_usd,
        )
        for i, s in enumerate(catalog)
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def stage_table(catalog: DataFrame) -> DataFrame:
    return catalog.select("catalog_index", "scenario", F.inline("stages"))


def lognormal_parameters(mean: Column, cv: Column) -> tuple[Column, Column]:
    """Location and shape of a lognormal with the given mean and coefficient of variation."""
    variance = cv * cv
    return F.ln(mean / F.sqrt(1 + variance)), F.sqrt(F.ln(1 + variance))


def guard(replications: int, cases: int, arrival_rate: float = 1.0) -> None:
    if replications < 2 or cases < 100:
        raise ValueError("scenario comparison requires at least 2 replications and 100 cases")
    if arrival_rate <= 0:
        raise ValueError("arrival_rate_per_hour must be positive")


def target_draw(u: Column) -> Column:
    """SLA target by a uniform draw."""
    out = F.lit(TARGET_MIX[-1][1])
    for limit, target in reversed(TARGET_MIX[:-1]):
        out = F.when(u < limit, target).otherwise(out)
    return out


@dataclass(frozen=True)
class StageMap:
    """How the catalog's stages and levers map to the activities of a log."""

    stage_activity: dict[str, str]
    lead_time_activities: tuple[str, ...] = ()
    rework_activities: tuple[str, ...] = ()


# Supplier steps and invoice rework steps of the purchase-to-pay log.
PURCHASE_TO_PAY = StageMap(
    {name: name for name, _, _ in BASE_STAGES},
    lead_time_activities=("Supplier Confirmation", "Delivery Delayed"),
    rework_activities=("Invoice Blocked", "Invoice Corrected"),
)


def wait_factors(
    scenario: Scenario, stages: StageMap, base: Scenario = CATALOG[0]
) -> dict[str, float]:
    """Multiplier of the wait into each activity: service time over seats, lead time, and
    rework against that of ``base``, the first of the catalog."""
    factors: dict[str, float] = {}
    for name, seats, _ in BASE_STAGES:
        if name in stages.stage_activity:
            ratio = scenario.service_factor.get(name, 1.0) * seats / scenario.seats.get(name, seats)
            factors[stages.stage_activity[name]] = ratio
    for activity in stages.lead_time_activities:
        factors[activity] = factors.get(activity, 1.0) * scenario.lead_time_factor
    baseline = base.rework_probability
    for activity in stages.rework_activities:
        factors[activity] = factors.get(activity, 1.0) * scenario.rework_probability / baseline
    return {a: f for a, f in factors.items() if not math.isclose(f, 1.0)}


def manual_factors(scenario: Scenario, stages: StageMap) -> dict[str, float]:
    """Multiplier of the manual time of each activity."""
    return {
        stages.stage_activity[name]: factor
        for name, factor in scenario.service_factor.items() if name in stages.stage_activity
    }


def _scaled(us: Column, activity: Column, factors: dict[str, float]) -> Column:
    scaled = us
    for name, factor in factors.items():
        scaled = F.when(activity == name, whole(us * factor)).otherwise(scaled)
    return scaled


def what_if(
    log: ProcessLog,
    stages: StageMap,
    cases: DataFrame | None = None,
    catalog: Sequence[Scenario] = CATALOG,
    seed: str = "what-if",
    replications: int | None = None,
) -> DataFrame:
    """Outcome of every observed case under every scenario.

    With ``replications`` each outcome carries the ``weights`` that ``replicated`` draws, hashed
    once per case and not once per scenario. A row per case is then written down, and every pass over
    the outcomes starts from it.

    The SLA target is the case's own, from ``cases``; without a case table it is drawn from the
    published mix by a hash of the case id.

    Waits and manual times are scaled by the scenario's levers and summed per case in one
    aggregate with a column pair per scenario; rows are multiplied by the catalog only
    after that, at one row per case.
    """
    rows = log.linked(
        "case_id", "activity", "timestamp", "automated", "processing_minutes",
        previous=("timestamp",),
    )
    wait = F.coalesce(elapsed_us(F.col("before.timestamp"), F.col("timestamp")), F.lit(0))
    manual = F.when(F.col("automated"), F.lit(0)).otherwise(
        minutes_to_us(F.col("processing_minutes"))
    )
    rows = rows.select(
        "case_id", "activity", "timestamp", wait.alias("wait_us"), manual.alias("manual_us")
    )
    sums = []
    for i, scenario in enumerate(catalog):
        for name, factors in (
            ("wait", wait_factors(scenario, stages, catalog[0])),
            ("manual", manual_factors(scenario, stages)),
        ):
            scaled = _scaled(F.col(f"{name}_us"), F.col("activity"), factors)
            sums.append(F.sum(scaled).alias(f"{name}_{i}"))
    per_case = rows.groupBy("case_id").agg(F.min("timestamp").alias("arrival"), *sums)
    if cases is None:
        per_case = per_case.withColumn(
            "sla_target_hours", target_draw(uniform(digest(seed, F.col("case_id")))))
    else:
        per_case = per_case.join(cases.select("case_id", "sla_target_hours"), "case_id", "left")
    outcomes = F.array(*[
        F.struct(
            F.lit(i).alias("catalog_index"), F.lit(s.name).alias("scenario"),
            F.col(f"wait_{i}").alias("cycle_us"), F.col(f"manual_{i}").alias("manual_us"),
        )
        for i, s in enumerate(catalog)
    ])
    weights = []
    if replications is not None:
        per_case, weights = durable(_with_weights(per_case, replications)), ["weights"]
    return per_case.select(
        "case_id", F.unix_micros("arrival").alias("arrival_us"), "sla_target_hours", *weights,
        F.inline(outcomes),
    )


# Weights of a bootstrap: how often a case is drawn is close to a Poisson variable of mean one. The
# limits are its distribution function; a weight beyond the last one has a chance under 1e-7.
POISSON_LIMITS = tuple(
    math.fsum(math.exp(-1) / math.factorial(k) for k in range(n + 1)) for n in range(10)
)


def poisson_weight(chunk: Column) -> Column:
    """The weight of a draw. Its hex digits are compared with those of the limits, which sort like the
    numbers they write, so no draw is turned into a number."""
    out = F.lit(len(POISSON_LIMITS))
    for k, limit in reversed(list(enumerate(POISSON_LIMITS))):
        out = F.when(chunk < drawn_below(limit), k).otherwise(out)
    return out


def _with_weights(
    rows: DataFrame, replications: int, seed: str = "bootstrap"
) -> DataFrame:
    """``weights``: how often each replication draws the row's case, by a hash of case and replication."""
    each = 5  # draws of a digest
    digests = settled(rows.withColumns({
        f"_d{i}": digest(seed, F.col("case_id"), F.lit(i)) for i in range(-(-replications // each))}))
    # A weight per element: one branch after the other for each would be too much code to compile.
    draws = F.array(*[drawn(F.col(f"_d{k // each}"), k % each) for k in range(replications)])
    weights = F.transform(draws, lambda u: poisson_weight(u).cast("int"))
    return digests.select(*rows.columns, weights.alias("weights"))


def replicated(
    outcomes: DataFrame, replications: int = 24, seed: str = "bootstrap", wide: bool = False
) -> DataFrame:
    """Every outcome in every replication that draws its case, with the ``weight`` it is drawn by.

    A replication is a bootstrap over all cases: the weight comes from a hash of case and replication,
    so it is the same for all scenarios, which are then compared on the same cases. ``weights`` that
    ``what_if`` has drawn are taken as they are. With ``wide`` an outcome stays one row, and its
    weights are the columns ``weight_0``, ``weight_1``, ..., null where a replication does not draw it.
    """
    if "weights" not in outcomes.columns:
        outcomes = _with_weights(outcomes, replications, seed)
    columns = [c for c in outcomes.columns if c != "weights"]
    if wide:
        drawn_by = (F.nullif(F.get("weights", F.lit(k)), F.lit(0)) for k in range(replications))
        return outcomes.select(
            *columns, *[w.alias(f"{WIDE}{k}") for k, w in enumerate(drawn_by)])
    return outcomes.select(
        *columns, F.posexplode("weights").alias("replication", "weight")).where("weight > 0")


WIDE = "weight_"
# So many replications are summed side by side: more would be too many columns for compiled code.
WIDE_SUMS = 8
PART_BITS = 22


def replication_outcomes(outcomes: DataFrame, max_groups: int | None = None) -> DataFrame:
    """Six outcome metrics per scenario and replication, each case by its ``weight``.

    A case without a target counts for all but the adherence. Takes what ``replicated`` returns in
    either form; of the wide one each outcome is read as one row by each pass.
    """
    keys = ["catalog_index", "scenario", "replication"]
    probs = {"median": 0.5, "p90": 0.9}
    weights = [c for c in outcomes.columns if c.startswith(WIDE)]
    if weights:
        rest = _wide_sums(outcomes, keys, weights)
        timing = lane_quantiles(outcomes, keys[:2], "cycle_us", probs, weights, keys[2], max_groups)
    else:
        weight = F.col("weight").cast("bigint")
        rest = outcomes.groupBy(*keys).agg(
            *_weighted_sums(weight, lambda us: wide_sum(us * weight)))
        timing = exact_quantiles(
            outcomes.withColumn("weight", weight), keys, "cycle_us", probs,
            max_groups=max_groups, weight="weight",
        )
    span_hours = F.greatest(F.col("span_us") / HOUR_US, F.lit(1.0))
    return rest.join(timing, keys).select(
        *keys, "cases",
        hours(share(F.col("total"), F.col("n"))).alias("mean_cycle_hours"),
        hours(F.col("median")).alias("median_cycle_hours"),
        hours(F.col("p90")).alias("p90_cycle_hours"),
        (1 - share(F.col("breached"), F.col("judged"))).alias("sla_adherence"),
        hours(share(F.col("manual"), F.col("cases"))).alias("manual_hours_per_case"),
        (F.col("cases") / span_hours * 8).alias("throughput_cases_per_8h"),
    )


def _weighted_sums(weight: Column, manual: Callable[[Column], Column], name: str = "{}") -> list[Column]:
    """The sums behind the metrics but those of the cycle, of rows whose ``weight`` is not null."""
    target = F.col("sla_target_hours")
    breached = F.when(target.isNotNull(), (hours(F.col("cycle_us")) > target).cast("int"))
    drawn_rows = weight.isNotNull()
    end = F.max(F.when(drawn_rows, F.col("arrival_us") + F.col("cycle_us")))
    sums = {
        "cases": F.sum(weight),
        "judged": F.sum(F.when(target.isNotNull(), weight)),
        "breached": F.sum(breached * weight),
        "span_us": end - F.min(F.when(drawn_rows, F.col("arrival_us"))),
        "manual": manual(F.col("manual_us")),
    }
    return [c.alias(name.format(n)) for n, c in sums.items()]


def _wide_sums(outcomes: DataFrame, keys: Sequence[str], weights: Sequence[str]) -> DataFrame:
    """The sums of ``_weighted_sums`` per replication, from one row per outcome."""
    *groups, lane = keys
    mask = F.lit((1 << PART_BITS) - 1)

    def exact(weight):
        # The parts of a number of 64 bits have sums of 64 bits, and together its exact sum.
        def total(us):
            parts = (us.bitwiseAND(mask), F.shiftright(us, PART_BITS).bitwiseAND(mask),
                     F.shiftright(us, 2 * PART_BITS))
            sums = [F.sum(p * weight).cast("decimal(19,0)") for p in parts]
            return reduce(lambda x, y: x + y, [
                s * F.lit(1 << (PART_BITS * i)) for i, s in enumerate(sums)])
        return total

    found = []
    for first in range(0, len(weights), WIDE_SUMS):
        lanes = range(first, min(first + WIDE_SUMS, len(weights)))
        sums = [c for k in lanes for c in _weighted_sums(
            F.col(weights[k]).cast("bigint"), exact(F.col(weights[k]).cast("bigint")), f"{{}}_{k}")]
        names = ("cases", "judged", "breached", "span_us", "manual")
        found.append(by_lane(
            outcomes.groupBy(*groups).agg(*sums), groups, {n: f"{n}_{{}}" for n in names}, lane, lanes))
    return reduce(DataFrame.unionByName, found).where("cases IS NOT NULL")


OUTCOME_COLUMNS = (
    "mean_cycle_hours", "median_cycle_hours", "p90_cycle_hours", "sla_adherence",
    "manual_hours_per_case", "throughput_cases_per_8h",
)


def mean_outcomes(per_replication: DataFrame) -> DataFrame:
    return per_replication.groupBy("catalog_index", "scenario").agg(
        *[F.avg(c).alias(c) for c in OUTCOME_COLUMNS]
    )


def compare(
    means: DataFrame, catalog: DataFrame, annual_volume: int = ANNUAL_CASE_VOLUME
) -> DataFrame:
    """Deltas against the first catalog row, yearly value and first-year return."""
    joined = means.join(
        F.broadcast(catalog.select("catalog_index", "description", "one_time_investment_usd")),
        "catalog_index",
    )
    first_row = Window.partitionBy().orderBy("catalog_index")  # one row per scenario

    def baseline(column):
        return F.first(column).over(first_row)

    def positive(value):
        return F.greatest(F.lit(0.0), value)

    cycle, adherence = F.col("mean_cycle_hours"), F.col("sla_adherence")
    manual = F.col("manual_hours_per_case")
    deltas = joined.withColumns({
        "cycle_time_reduction_pct": positive(1 - cycle / baseline("mean_cycle_hours")),
        "sla_adherence_uplift_pp": (adherence - baseline("sla_adherence")) * 100,
        "manual_hours_saved_per_case": positive(baseline("manual_hours_per_case") - manual),
        "_delay": positive(baseline("mean_cycle_hours") - cycle),
        "_breach": positive(adherence - baseline("sla_adherence")),
    })
    value = annual_volume * (
        F.col("_delay") * DELAY_HOUR_USD
        + F.col("manual_hours_saved_per_case") * MANUAL_HOUR_USD
        + F.col("_breach") * BREACH_USD
    )
    invested = F.col("one_time_investment_usd")
    return deltas.withColumn("estimated_annual_value_usd", value).select(
        "catalog_index", "scenario", "description", "one_time_investment_usd", *OUTCOME_COLUMNS,
        "cycle_time_reduction_pct", "sla_adherence_uplift_pp", "manual_hours_saved_per_case",
        "estimated_annual_value_usd",
        F.when(invested > 0, (F.col("estimated_annual_value_usd") - invested) / invested)
        .otherwise(0.0).alias("first_year_roi"),
    )


def recommend(compared: DataFrame, by_value: bool = False) -> DataFrame:
    """The last catalog row, or the scenario with the highest yearly value."""
    order = F.struct("estimated_annual_value_usd", "catalog_index") if by_value else F.col(
        "catalog_index"
    )
    best = F.max_by(F.struct(*compared.columns), order)
    return compared.agg(best.alias("best")).select(
        F.col("best.scenario").alias("recommended_scenario"),
        F.round("best.cycle_time_reduction_pct", 4).alias("recommended_cycle_reduction_pct"),
        F.round("best.sla_adherence_uplift_pp", 2).alias("recommended_sla_uplift_pp"),
        F.round("best.estimated_annual_value_usd", 2).alias("estimated_annual_value_usd"),
        F.round("best.first_year_roi", 4).alias("first_year_roi"),
    )
