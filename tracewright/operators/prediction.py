"""SLA-breach risk: leakage-safe features, temporal split, model, metrics, explanations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
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
from tracewright.functions.selection import select_key
from tracewright.log import ProcessLog
from tracewright.model import APPROVAL_ACTIVITY, DECISION_ACTIVITY, REWORK_ACTIVITY
from tracewright.session import broadcast_if_small, durable

# Model inputs in order.
NUMERIC_FEATURES = (
    "amount_usd", "elapsed_to_po_hours", "early_event_count", "approval_count",
    "early_rework_count", "early_manual_minutes",
)
CATEGORICAL_FEATURES = (
    "business_unit", "department", "country", "vendor_tier", "material_category",
    "priority", "channel",
)
# Risk bands, right-closed upper limits.
RISK_BANDS = (("Low", 0.30), ("Medium", 0.60), ("High", 0.80), ("Critical", None))
SCORE_THRESHOLD = 0.50
ROWS_PER_TRAIN_TASK = 100_000


@dataclass(frozen=True)
class SlaModel:
    """The scored holdout, its metrics row, the coefficient table, and the prepared training rows
    with label, weight and fitted probability."""

    scored: DataFrame
    metrics: DataFrame
    drivers: DataFrame
    trained: DataFrame


# --- features ---------------------------------------------------------------------------


def _early_events(log: ProcessLog, decision: str) -> DataFrame:
    """Events up to the first decision event of their case; all of them if there is none."""
    columns = ("case_id", "activity", "timestamp", "automated", "processing_minutes")
    cut = F.min(F.when(F.col("activity") == decision, F.col("timestamp")))
    rows = log.dealt(log.regular.select(*columns)).select(
        *columns, cut.over(Window.partitionBy("case_id")).alias("po_created_at")
    )
    if log.has_long_cases:
        cuts = log.segments.groupBy("case_id").agg(cut.alias("po_created_at"))
        # At most events / case_limit cases are that long.
        cuts = broadcast_if_small(cuts, log.facts.events // log.case_limit)
        rows = rows.unionByName(log.segments.select(*columns).join(cuts, "case_id"))
    return rows.where(
        F.col("po_created_at").isNull() | (F.col("timestamp") <= F.col("po_created_at"))
    )


def sla_features(
    log: ProcessLog,
    cases: DataFrame,
    decision: str = DECISION_ACTIVITY,
    approval: str = APPROVAL_ACTIVITY,
    rework: str = REWORK_ACTIVITY,
    drop_uncut: bool = False,
) -> DataFrame:
    """Cases with the features known when the decision event happens.

    A case without that event keeps all its events and its full cycle time, which leaks the
    outcome; ``drop_uncut`` leaves such cases out.
    """
    manual = F.when(~F.col("automated"), minutes_to_us(F.col("processing_minutes")))
    early = _early_events(log, decision).groupBy("case_id").agg(
        F.max("po_created_at").alias("po_created_at"),
        F.count(F.lit(1)).alias("early_event_count"),
        F.count_if(F.col("activity") == approval).alias("approval_count"),
        F.count_if(F.col("activity") == rework).alias("early_rework_count"),
        wide_sum(F.coalesce(manual, F.lit(0))).alias("_manual_us"),
    )
    # Dealt like the events, so that the early aggregates meet their cases where they are.
    frame = log.dealt(cases).join(early, "case_id", "inner" if drop_uncut else "left")
    if drop_uncut:
        frame = frame.where(F.col("po_created_at").isNotNull())
    elapsed = hours(elapsed_us(F.col("created_at"), F.col("po_created_at")))
    counts = ("early_event_count", "approval_count", "early_rework_count")
    return frame.select(
        *cases.columns,
        "po_created_at",
        F.coalesce(elapsed, F.col("cycle_time_hours")).alias("elapsed_to_po_hours"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts],
        F.coalesce(minutes(F.col("_manual_us")), F.lit(0.0)).alias("early_manual_minutes"),
    )


# --- split ------------------------------------------------------------------------------


def temporal_split(frame: DataFrame, holdout_share: float = 0.20) -> DataFrame:
    """Add ``is_train``: the earliest cases by ``(created_at, case_id)``.

    The one boundary key is found by counting, and the rows are labelled by comparing with it:
    nothing is sorted, ranked or joined. One case alone is training data. Case ids are unique.
    """
    if not 0.10 <= holdout_share <= 0.40:
        raise ValueError("holdout_share must be between 0.10 and 0.40")
    created = F.unix_micros("created_at")
    total = frame.count()
    if total == 0:
        return frame.withColumn("is_train", F.lit(True))
    wanted = max(1, min(total - 1, int(total * (1 - holdout_share))))
    moment, case = select_key(
        frame.select(created.alias("created_us"), "case_id"), "created_us", "case_id", wanted)
    here = F.struct(created.alias("created_us"), "case_id")
    edge = F.struct(F.lit(moment).alias("created_us"), F.lit(case).alias("case_id"))
    return frame.withColumn("is_train", here <= edge)


# --- model ------------------------------------------------------------------------------


def _medians(train: DataFrame) -> dict[str, float]:
    """Exact medians of the numeric features, on a grid of one millionth."""
    scale = 1_000_000
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.round(F.col(c) * scale).cast("bigint").alias("v"))
        for c in NUMERIC_FEATURES
    ])
    long = train.select(F.inline(pairs))
    rows = exact_quantiles(
        long, ["feature"], "v", {"median": 0.5}, max_groups=len(NUMERIC_FEATURES)
    ).collect()  # one row per feature
    return {r["feature"]: r["median"] / scale for r in rows}


def _modes(rows: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The most frequent label of each column, of equally frequent ones the smallest.

    Labels are counted on the map side and by (column, label), so no task holds the labels of a
    column: a column may have as many as there are rows.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("label")) for c in columns])
    counted = rows.select(F.inline(pairs)).where(F.col("label").isNotNull()).groupBy(
        "name", "label").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), "label"))
    found = counted.groupBy("name").agg(best.alias("best")).collect()  # one row per column
    return {r["name"]: r["best"]["label"] for r in found}


def _prepared(frame: DataFrame) -> DataFrame:
    """Impute and standardise with statistics of the training rows only.

    One aggregate gives everything when no numeric value is missing, as the contract asks;
    otherwise medians come first and the statistics are taken over the filled values.
    """

    def statistics(filled):
        def of_train(column):
            return F.when(F.col("is_train"), column)

        return frame.agg(
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in NUMERIC_FEATURES],
            *[F.avg(of_train(filled[c])).alias(f"mean_{c}") for c in NUMERIC_FEATURES],
            *[F.stddev_pop(of_train(filled[c])).alias(f"sd_{c}") for c in NUMERIC_FEATURES],
        ).first()

    filled = {c: F.col(c).cast("double") for c in NUMERIC_FEATURES}
    stats = statistics(filled)
    if any(stats[f"null_{c}"] for c in NUMERIC_FEATURES):
        medians = _medians(frame.where("is_train"))
        filled = {c: F.coalesce(v, F.lit(medians.get(c, 0.0))) for c, v in filled.items()}
        stats = statistics(filled)
    modes = _modes(frame.where("is_train"), CATEGORICAL_FEATURES)
    numeric = {
        f"z_{c}": (filled[c] - F.lit(stats[f"mean_{c}"])) / F.lit(stats[f"sd_{c}"] or 1.0)
        for c in NUMERIC_FEATURES
    }
    labels = {
        c: F.coalesce(F.col(c), F.lit(modes.get(c)), F.lit("")) for c in CATEGORICAL_FEATURES
    }
    return frame.withColumns({**numeric, **labels, "label": F.col("sla_breached").cast("double")})


def train_sla_model(features: DataFrame, holdout_share: float = 0.20) -> SlaModel:
    """Balanced L2 logistic regression on the earlier cases, scored on the later ones."""
    frame = temporal_split(durable(features), holdout_share)
    train = frame.where("is_train")
    sizes = {r["sla_breached"]: r["n"] for r in train.groupBy("sla_breached").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    sizes.pop(None, None)
    if len(sizes) < 2:
        raise ValueError("training data must contain both SLA outcome classes")
    total = sum(sizes.values())
    weight = F.when(F.col("sla_breached"), total / (2 * sizes[True])).otherwise(
        total / (2 * sizes[False])
    )
    ready = _prepared(frame).withColumn("weight", weight)
    indexed = [f"{c}_index" for c in CATEGORICAL_FEATURES]
    encoded = [f"{c}_code" for c in CATEGORICAL_FEATURES]
    numeric = [f"z_{c}" for c in NUMERIC_FEATURES]
    # handleInvalid="keep" adds a level for unseen labels and dropLast removes just that one,
    # so an unseen label is all zeros and every known level keeps its column.
    stages = [
        StringIndexer(inputCols=list(CATEGORICAL_FEATURES), outputCols=indexed,
                      stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=[*numeric, *encoded], outputCol="vector"),
        LogisticRegression(
            featuresCol="vector", labelCol="label", weightCol="weight",
            regParam=1.0 / total, elasticNetParam=0.0, standardization=False,
            maxIter=1000, tol=1e-8,
        ),
    ]
    # Every iteration is a job, so a small training set is better off in few partitions;
    # coalescing to more partitions than there are changes nothing.
    rows = ready.where("is_train").coalesce(total // ROWS_PER_TRAIN_TASK + 1)
    model = Pipeline(stages=stages).fit(rows)
    probability = vector_to_array(F.col("probability"))
    scored = model.transform(ready.where(~F.col("is_train"))).withColumn(
        "risk_score", F.get(probability, F.lit(1))
    )
    scored = durable(scored_output(scored))
    trained = model.transform(ready.where("is_train")).select(
        "case_id", "label", "weight", F.get(probability, F.lit(1)).alias("probability"),
        *numeric, *CATEGORICAL_FEATURES)
    names = list(NUMERIC_FEATURES) + [
        f"{column}_{label}"
        for column, labels in zip(CATEGORICAL_FEATURES, model.stages[0].labelsArray, strict=True)
        for label in labels
    ]
    weights = [float(x) for x in model.stages[-1].coefficients]
    return SlaModel(
        scored=scored,
        metrics=model_metrics(scored, total),
        drivers=drivers(frame.sparkSession.createDataFrame(
            list(zip(names, weights, strict=True)), "feature string, coefficient double"
        )),
        trained=trained,
    )


def fit_certificate(model: SlaModel) -> DataFrame:
    """``feature, gradient``: the gradient of the penalised loss at the fitted coefficients, per case.

    It is zero in every feature exactly at the optimum, so this proves the fit (with the imputation,
    scaling, encoding and weights before it) from the training rows and the coefficient table
    alone. Each row adds its weighted residual times its value to each of its features;
    the sums are combined on the map side.
    """
    residual = F.col("weight") * (F.col("probability") - F.col("label"))
    parts = [F.struct(F.lit(c).alias("feature"), (residual * F.col(f"z_{c}")).alias("r"))
             for c in NUMERIC_FEATURES]
    parts += [F.struct(F.concat(F.lit(f"{c}_"), F.col(c)).alias("feature"), residual.alias("r"))
              for c in CATEGORICAL_FEATURES]
    sums = model.trained.select(F.inline(F.array(*parts))).groupBy("feature").agg(F.sum("r").alias("r"))
    cases = model.trained.select(F.count(F.lit(1))).scalar()
    return sums.join(model.drivers.select("feature", "coefficient"), "feature", "full_outer").select(
        "feature", ((F.col("r") + F.col("coefficient")) / cases).alias("gradient"))


def risk_band(score: Column) -> Column:
    band = F.lit(RISK_BANDS[-1][0])
    for label, limit in reversed(RISK_BANDS[:-1]):
        band = F.when(score <= limit, label).otherwise(band)
    return band


def scored_output(frame: DataFrame) -> DataFrame:
    """Scored cases with prediction and band; the slicer dimensions ride along."""
    score = F.col("risk_score")
    return frame.select(
        "case_id", "created_at", "business_unit", "vendor_id", "amount_usd", "sla_breached",
        "risk_score",
        (score >= SCORE_THRESHOLD).alias("predicted_breach"),
        risk_band(score).alias("risk_band"),
        *[c for c in ("priority", "vendor_tier", "country") if c in frame.columns],
    )


def drivers(coefficients: DataFrame) -> DataFrame:
    """Coefficient size and direction, strongest first."""
    return coefficients.select(
        "feature", "coefficient",
        F.abs("coefficient").alias("absolute_importance"),
        F.when(F.col("coefficient") >= 0, "higher_risk").otherwise("lower_risk")
        .alias("direction"),
    ).orderBy(F.desc("absolute_importance"), "feature")


# --- metrics ----------------------------------------------------------------------------


def rank_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC (ties count half) and step-wise average precision, per group.

    Scores are counted first, so equal scores are one row, and running class counts come
    from the distributed prefix; the group's own start is subtracted from them.
    """
    by = list(by)
    counted = scored.groupBy(*by, "risk_score").agg(
        F.count_if("sla_breached").alias("pos"),
        F.count_if(~F.col("sla_breached")).alias("neg"),
    )
    order = [*[F.col(c).asc() for c in by], F.col("risk_score").desc()]
    curve = durable(global_prefix(counted, order, sums=["pos", "neg"]))
    groups = curve.groupBy(*by).agg(
        F.sum("pos").alias("P"), F.sum("neg").alias("N"),
        F.min(F.col("cum_pos") - F.col("pos")).alias("pos_start"),
        F.min(F.col("cum_neg") - F.col("neg")).alias("neg_start"),
    )
    if by:
        points = curve.join(broadcast_if_small(groups, groups.count()), by)
    else:
        row = groups.first()
        points = curve.withColumns({c: F.lit(row[c]) for c in groups.columns})
    tp = F.col("cum_pos") - F.col("pos_start")
    fp = F.col("cum_neg") - F.col("neg_start")
    above = F.col("neg") * (tp - F.col("pos") + F.col("pos") / 2)
    table = points.groupBy(*by).agg(
        F.max("P").alias("P"), F.max("N").alias("N"),
        F.sum(above).alias("pairs"),
        F.sum(F.col("pos") * share(tp, tp + fp)).alias("precision_sum"),
    )
    positive_rate = share(F.col("P"), F.col("P") + F.col("N"))
    pairs = F.col("P").cast("double") * F.col("N")
    return table.select(
        *by,
        F.coalesce(F.try_divide(F.col("pairs"), pairs), F.lit(0.5)).alias("roc_auc"),
        F.coalesce(F.try_divide(F.col("precision_sum"), F.col("P").cast("double")), positive_rate)
        .alias("average_precision"),
    )


def threshold_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts and the metrics that follow from them, in one aggregate."""
    y, p = F.col("sla_breached"), F.col("predicted_breach")
    counts = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("cases"),
        F.count_if(~y & ~p).alias("true_negative"),
        F.count_if(~y & p).alias("false_positive"),
        F.count_if(y & ~p).alias("false_negative"),
        F.count_if(y & p).alias("true_positive"),
        F.avg(F.pow(F.col("risk_score") - y.cast("int"), F.lit(2))).alias("brier_score"),
        rate(y).alias("positive_rate"),
    )
    tp, fp = F.col("true_positive"), F.col("false_positive")
    fn, tn = F.col("false_negative"), F.col("true_negative")
    zero = F.lit(0.0)
    return counts.select(
        *by, "cases", "positive_rate",
        share(tp + tn, F.col("cases")).alias("accuracy"),
        F.coalesce(share(tp, tp + fp), zero).alias("precision"),
        F.coalesce(share(tp, tp + fn), zero).alias("recall"),
        F.coalesce(share(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
        "brier_score", "true_negative", "false_positive", "false_negative", "true_positive",
    )


def model_metrics(scored: DataFrame, train_cases: int) -> DataFrame:
    """The metrics row, with the confusion matrix as a struct."""
    ranked = rank_metrics(scored)
    matrix = F.struct("true_negative", "false_positive", "false_negative", "true_positive")
    return threshold_metrics(scored).select(
        F.lit("LogisticRegression").alias("model"),
        F.lit("temporal_holdout").alias("validation"),
        F.lit(train_cases).alias("train_cases"),
        F.col("cases").alias("holdout_cases"),
        F.col("positive_rate").alias("positive_rate_holdout"),
        ranked.select("roc_auc").scalar().alias("roc_auc"),
        ranked.select("average_precision").scalar().alias("average_precision"),
        "accuracy", "precision", "recall", "f1", "brier_score",
        matrix.alias("confusion_matrix"),
    )


def subgroup_metrics(scored: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Rank and threshold metrics per member of each dimension and per creation month."""
    pairs = [
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("member"))
        for d in dimensions
    ]
    month = F.date_format("created_at", "yyyy-MM")
    pairs.append(F.struct(F.lit("created_month").alias("dimension"), month.alias("member")))
    rows = scored.select(
        "sla_breached", "risk_score", "predicted_breach", F.inline(F.array(*pairs))
    )
    keys = ["dimension", "member"]
    return threshold_metrics(rows, keys).join(rank_metrics(rows, keys), keys)


def metric_changes(
    current: DataFrame, approved: DataFrame, keys: Sequence[str] = ("dimension", "member"),
    metrics: Sequence[str] = ("roc_auc", "average_precision", "recall", "brier_score"),
) -> DataFrame:
    """Current metrics, approved ones and their difference per group."""
    names = [m for m in metrics if m in current.columns]
    before = approved.select(*keys, *[F.col(m).alias(f"approved_{m}") for m in names])
    joined = current.select(*keys, *names).join(before, list(keys), "full_outer")
    return joined.select(
        *keys, *names, *[f"approved_{m}" for m in names],
        *[(F.col(m) - F.col(f"approved_{m}")).alias(f"{m}_change") for m in names],
    )


def risk_distribution(scored: DataFrame) -> DataFrame:
    """Cases per band in fixed order, empty bands included."""
    counts = scored.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("risk_band") == label).alias(label) for label, _ in RISK_BANDS],
    )
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("band_order"), F.lit(label).alias("risk_band"),
            F.col(label).alias("case_count"),
            F.round(F.col(label) / F.greatest("total", F.lit(1)), 4).alias("case_share"),
        )
        for i, (label, _) in enumerate(RISK_BANDS, start=1)
    ])
    return counts.select(F.inline(rows))


def review_queue(scored: DataFrame, limit: int | None = None) -> DataFrame:
    """High and critical cases by score, then amount; all of them unless a limit is given."""
    queue = scored.where(F.col("risk_band").isin("High", "Critical")).orderBy(
        F.desc("risk_score"), F.desc("amount_usd"), "case_id"
    ).select("case_id", "business_unit", "vendor_id", "amount_usd", "risk_score", "risk_band")
    return queue if limit is None else queue.limit(limit)


