from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import SF, rows
from tracewright.log import ProcessLog
from tracewright.operators import prediction
from tracewright.session import durable
from tracewright.sources import adapters


@pytest.fixture(scope="module")
def process(spark):
    events = durable(adapters.order_process_events(spark, SF))
    cases = durable(adapters.order_process_cases(spark, SF))
    return ProcessLog(events, adapters.ORDER_SORT), cases


ROLES = (adapters.ORDER_DECISION, adapters.ORDER_APPROVAL, adapters.ORDER_REWORK)


@pytest.fixture(scope="module")
def features(process):
    return durable(prediction.sla_features(*process, *ROLES))


@pytest.fixture(scope="module")
def model(features):
    return prediction.train_sla_model(features)


def test_features(process, features):
    wanted = set(prediction.NUMERIC_FEATURES + prediction.CATEGORICAL_FEATURES)
    assert wanted <= set(features.columns)
    assert features.count() == process[1].count() > 1000
    assert features.where("early_event_count < 1").isEmpty()
    # The decision event is the first shipped line, so what was accepted or returned came before it.
    decided = features.where("po_created_at is not null")
    assert decided.where(
        "early_event_count < 1 + approval_count + early_rework_count").isEmpty()


def test_cases_without_a_decision(process):
    log, cases = process
    undecided = ProcessLog(log.events.where(F.col("activity") != adapters.ORDER_DECISION), log.order)
    kept = prediction.sla_features(undecided, cases, *ROLES)
    assert kept.where("elapsed_to_po_hours <> cycle_time_hours").isEmpty()
    assert prediction.sla_features(undecided, cases, *ROLES, drop_uncut=True).isEmpty()


def test_model(features, model):
    metrics = rows(model.metrics)[0]
    assert metrics["validation"] == "temporal_holdout"
    total = features.count()
    held = total - int(total * 0.8)
    assert (metrics["train_cases"], metrics["holdout_cases"]) == (total - held, held)
    assert 0.6 <= metrics["roc_auc"] <= 1
    assert sum(metrics["confusion_matrix"].values()) == held
    assert {r["risk_band"] for r in rows(model.scored)} <= {"Low", "Medium", "High", "Critical"}
    bands = rows(prediction.risk_distribution(model.scored))
    assert [r["risk_band"] for r in bands] == ["Low", "Medium", "High", "Critical"]
    assert sum(r["case_count"] for r in bands) == held
    sizes = [r["absolute_importance"] for r in rows(model.drivers)]
    assert len(sizes) > 20
    assert sizes == sorted(sizes, reverse=True)
    queue = rows(prediction.review_queue(model.scored))
    assert all(r["risk_score"] > 0.6 for r in queue)


def test_coefficients_are_the_optimum(features, model):
    """The gradient of the balanced C=1 objective vanishes at the fitted coefficients."""
    import numpy as np

    frame = prediction.temporal_split(features)
    ready = prediction._prepared(frame).where("is_train").toPandas()
    names = {r["feature"]: r["coefficient"] for r in rows(model.drivers)}
    columns, weights = [], []
    for name, value in names.items():
        if name in prediction.NUMERIC_FEATURES:
            columns.append(ready[f"z_{name}"].to_numpy(float))
        else:
            column = next(c for c in prediction.CATEGORICAL_FEATURES if name.startswith(c + "_"))
            columns.append((ready[column] == name[len(column) + 1:]).to_numpy(float))
        weights.append(value)
    x, w = np.column_stack(columns), np.array(weights)
    y = ready["label"].to_numpy(float)
    share = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    b = 0.0
    for _ in range(100):  # the intercept is not in the table: solve for it
        p = 1 / (1 + np.exp(-(x @ w + b)))
        b -= np.sum(share * (p - y)) / np.sum(share * p * (1 - p))
    gradient = x.T @ (share * (1 / (1 + np.exp(-(x @ w + b))) - y)) + w
    assert np.abs(gradient).max() < 1e-2


def test_missing_values_are_imputed(features):
    frame = prediction.temporal_split(features).withColumns({
        "amount_usd": F.when(F.col("vendor_tier") != "A", F.col("amount_usd")),
        "channel": F.when(F.col("vendor_tier") != "A", F.col("channel")),
    })
    train = frame.where("is_train").toPandas()
    ready = prediction._prepared(frame).toPandas()
    filled = train["amount_usd"].fillna(train["amount_usd"].median())
    gaps = ready[ready["vendor_tier"] == "A"]
    expected = (train["amount_usd"].median() - filled.mean()) / filled.std(ddof=0)
    assert gaps["z_amount_usd"].to_numpy() == pytest.approx(expected)
    assert set(gaps["channel"]) == {train["channel"].mode()[0]}


@pytest.mark.parametrize("part", [0.09, 0.41])
def test_holdout_share_is_checked(features, part):
    with pytest.raises(ValueError, match="holdout_share"):
        prediction.temporal_split(features, part)


def test_two_classes_are_needed(features):
    with pytest.raises(ValueError, match="both SLA"):
        prediction.train_sla_model(features.withColumn("sla_breached", F.lit(False)))


def test_split_of_one_case(features):
    one = prediction.temporal_split(features.limit(1))
    assert one.count() == one.where("is_train").count() == 1


def brute_ranking(points):
    positives = [s for s, y in points if y]
    negatives = [s for s, y in points if not y]
    pairs = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    auc = pairs / (len(positives) * len(negatives)) if positives and negatives else 0.5
    ap, seen_tp, seen = 0.0, 0, 0
    for score in sorted({s for s, _ in points}, reverse=True):
        hits = [y for s, y in points if s == score]
        seen_tp, seen = seen_tp + sum(hits), seen + len(hits)
        ap += sum(hits) / max(len(positives), 1) * seen_tp / seen
    return auc, ap


def test_rank_metrics_match_brute_force(spark):
    rng = random.Random(8)
    data = [(g, round(rng.random(), 1), rng.random() < 0.4) for g in "ab" for _ in range(150)]
    data += [("none", 0.5, False)] * 4 + [("all", 0.3, True)] * 3
    df = spark.createDataFrame(data, "g string, risk_score double, sla_breached boolean")
    for row in rows(prediction.rank_metrics(df, ["g"])):
        auc, ap = brute_ranking([(s, y) for g, s, y in data if g == row["g"]])
        assert row["roc_auc"] == pytest.approx(auc)
        assert row["average_precision"] == pytest.approx(ap)
    total = rows(prediction.rank_metrics(df))[0]
    auc, ap = brute_ranking([(s, y) for _, s, y in data])
    assert (total["roc_auc"], total["average_precision"]) == pytest.approx((auc, ap))


def test_risk_band_edges(spark):
    df = spark.createDataFrame([(s,) for s in (0.3, 0.31, 0.6, 0.8, 0.81)], "s double")
    got = [r[0] for r in df.select(prediction.risk_band(F.col("s"))).collect()]
    assert got == ["Low", "Medium", "Medium", "High", "Critical"]


def test_subgroups(model):
    table = rows(prediction.subgroup_metrics(model.scored, ["priority"]))
    by_priority = [r for r in table if r["dimension"] == "priority"]
    assert sum(r["cases"] for r in by_priority) == model.scored.count()
    assert {"created_month", "priority"} == {r["dimension"] for r in table}


def test_review_queue_keeps_every_case(spark):
    scored = spark.range(150).selectExpr(
        "cast(id as string) AS case_id", "'B' AS business_unit", "'V' AS vendor_id",
        "cast(id as double) AS amount_usd", "0.9 AS risk_score", "'High' AS risk_band")
    assert prediction.review_queue(scored).count() == 150
    assert prediction.review_queue(scored, limit=100).count() == 100
