from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tracewright.model import CASE_COLUMNS, EVENT_COLUMNS, raw_schema
from tracewright.operators import contracts
from tracewright.operators.contracts import ContractError

SHARED = dict(case_id="T-88", business_unit="Repairs", department="Bench", country="Chile",
              vendor_id="S-204", vendor_tier="B", material_category="Tools", amount_usd="75.5",
              priority="Urgent", channel="Counter")
CASE = SHARED | dict(
    created_at="2025-07-14T09:30:00Z", completed_at="2025-07-16T18:15:00Z",
    variant_ground_truth="rush", event_count="2", rework_count="1", cycle_time_hours="56.75",
    sla_target_hours="48", sla_breached="1")
EVENT = SHARED | dict(
    event_index="1", activity="Intake", timestamp="2025-07-14T09:30:00Z", resource_id="CLERK-2",
    resource_role="Clerk", automated="0", processing_minutes="4.5", source_system="WMS")
SECOND = EVENT | dict(event_index="2", activity="Ship", timestamp="2025-07-16T18:15:00Z",
                      automated="true")


def event_frame(spark, *extra):
    data = [tuple(r[c] for c in EVENT_COLUMNS) for r in (SECOND, EVENT, *extra)]
    return spark.createDataFrame(data, raw_schema(EVENT_COLUMNS))


def case_frame(spark, **changes):
    row = {**CASE, **changes}
    return spark.createDataFrame([tuple(row[c] for c in CASE_COLUMNS)], raw_schema(CASE_COLUMNS))


def test_events_are_typed(spark):
    table = contracts.validate_events(event_frame(spark)).orderBy("event_index").collect()
    assert [r.automated for r in table] == [False, True]
    assert [r.event_index for r in table] == [1, 2]
    assert table[0].amount_usd == 75.5


def one_row(column, value, index="2"):
    """Puts a text into one row of the events only."""
    return lambda df: df.withColumn(column, F.when(
        F.col("event_index") == index, F.lit(value)).otherwise(F.col(column)))


BROKEN_EVENTS = {
    "boolean": one_row("automated", "perhaps"),
    "cannot be negative": one_row("processing_minutes", "-0.5"),
    "contain invalid values": one_row("amount_usd", "75,5 USD"),
    "event_index": one_row("event_index", "second"),
    "timestamp contains invalid": one_row("timestamp", "14/07/25"),
    "cannot contain null": one_row("activity", None, "1"),
    "must be unique": one_row("event_index", "1"),
    "at least one event": lambda df: df.where("case_id is null"),
    "missing required": lambda df: df.drop("source_system", "channel"),
}


@pytest.mark.parametrize("message", BROKEN_EVENTS)
def test_bad_events_are_rejected(spark, message):
    with pytest.raises(ContractError, match=message):
        contracts.validate_events(BROKEN_EVENTS[message](event_frame(spark)))


def test_first_broken_rule_wins(spark):
    broken = event_frame(spark).withColumns(
        {"automated": F.lit("maybe"), "timestamp": F.lit("bad")}
    )
    with pytest.raises(ContractError, match="timestamp"):
        contracts.validate_events(broken)


BROKEN_CASES = {
    "boolean": {"sla_breached": "late"},
    "cannot be negative": {"sla_target_hours": "-48"},
    "numeric": {"rework_count": "none"},
    "created_at": {"created_at": "yesterday"},
    "cannot precede": {"completed_at": "2025-07-14T09:29:59Z"},
}


@pytest.mark.parametrize("message", BROKEN_CASES)
def test_bad_cases_are_rejected(spark, message):
    with pytest.raises(ContractError, match=message):
        contracts.validate_cases(case_frame(spark, **BROKEN_CASES[message]))


def test_cases_need_rows_columns_and_single_ids(spark):
    frame = case_frame(spark)
    for broken, message in ((frame.where("case_id is null"), "at least one case"),
                            (frame.drop("vendor_tier"), "missing required"),
                            (frame.unionByName(case_frame(spark, channel="Phone")), "unique")):
        with pytest.raises(ContractError, match=message):
            contracts.validate_cases(broken)


def test_reconcile(spark):
    events = contracts.validate_events(event_frame(spark))
    contracts.load(event_frame(spark), case_frame(spark))
    with pytest.raises(ContractError, match=r"identifiers differ.*\['T-88'\].*\['T-90'\]"):
        contracts.reconcile(events, contracts.validate_cases(case_frame(spark, case_id="T-90")))
    with pytest.raises(ContractError, match="does not reconcile"):
        contracts.reconcile(events, contracts.validate_cases(case_frame(spark, event_count="3")))


def test_strict_order(spark):
    back = {**EVENT, "event_index": "3", "timestamp": "2025-07-15T00:00:00Z"}
    events = event_frame(spark, back)
    contracts.validate_events(events)
    with pytest.raises(ContractError, match="monotonic"):
        contracts.validate_events(events, strict_order=True)


def test_domain_and_blank_counts(spark):
    cases = contracts.typed_cases(case_frame(spark, vendor_tier="Z", sla_target_hours="0"))
    found = rows(contracts.domain_violations(cases))[0]
    assert found["vendor_tier"] == found["sla_target_hours"] == 1
    assert found["priority"] == 0
    blank = event_frame(spark).withColumn("resource_id", F.lit("  "))
    counted = {r["column_name"]: r for r in rows(
        contracts.null_required(blank, ["case_id", "resource_id"]))}
    assert counted["resource_id"]["blank_count"] == 2
    assert counted["case_id"]["blank_count"] == 0


def test_secrets(spark):
    texts = [
        (1, "key AKIA" + "A1" * 8 + " end"), (2, "ghp_" + "a" * 36),
        (3, "-----BEGIN RSA PRIVATE KEY-----"), (4, "xoxb-" + "1" * 20),
        (5, "nothing"), (6, "AKIA" + "a" * 16), (7, "x" * 50_000 + " ghs_" + "Z" * 40),
    ]
    df = spark.createDataFrame(texts, "id int, text string")
    found = {(r["doc"], r["label"]) for r in rows(contracts.secret_findings(df, "id"))}
    assert found == {(1, "AWS access key"), (2, "GitHub token"), (3, "private key"),
                     (4, "Slack token"), (7, "GitHub token")}
    assert {r["label"]: r["finding_count"] for r in rows(contracts.secret_summary(df))} == {
        "AWS access key": 1, "GitHub token": 2, "private key": 1, "Slack token": 1}


def test_golden_check(spark):
    actual = spark.createDataFrame([("a", 1.00005), ("b", 2.0)], "metric string, value double")
    expected = spark.createDataFrame(
        [("a", 1.0, 1e-4), ("b", 2.1, 1e-4), ("c", 1.0, 1e-4)],
        "metric string, expected double, tolerance double")
    assert {r["metric"]: r["passed"] for r in rows(contracts.golden_check(actual, expected))} == {
        "a": True, "b": False, "c": False}


def test_typed_nan_is_not_a_number(spark):
    from pyspark.sql import functions as F

    from tracewright.operators.contracts import _number

    df = spark.createDataFrame([(float("nan"), "NaN"), (1.5, "1.5")], "typed double, text string")
    rows = df.select(_number(df, "typed", "double").alias("a"),
                     _number(df, "text", "double").alias("b")).where(F.col("a").isNull()).collect()
    assert [(r.a, r.b) for r in rows] == [(None, None)]


def test_constraint_table(spark):
    """Each kind of constraint broken a known number of times; nulls as SQL treats them."""
    parents = spark.createDataFrame(
        [(1, "x"), (2, "y"), (2, "y"), (None, "z")], "id int, name string")
    children = spark.createDataFrame(
        [(1, "a", 5.0), (1, "a", -1.0), (9, "a", None), (9, "b", 0.0), (None, "c", 2.0), (2, None, 3.0),
         (2, None, 4.0)], "parent int, code string, amount double")
    declared = [
        ("parents", "primary key", ("id",), None), ("parents", "not null", ("name",), None),
        ("children", "foreign key", ("parent",), "parents(id)"),
        ("children", "unique", ("parent", "code"), None), ("children", "not null", ("code",), None),
        ("children", "check", ("amount",), "amount >= 0"),
    ]
    tables = {"parents": parents, "children": children}
    found = contracts.constraint_violations(tables, contracts.constraint_table(spark, declared))
    assert {(r["table"], r["kind"], r["columns"]): r["violations"] for r in rows(found)} == {
        ("parents", "primary key", "id"): 2,  # one repeat and one null
        ("parents", "not null", "name"): 0,
        ("children", "foreign key", "parent"): 2,  # 9 twice; a null refers to nothing
        ("children", "unique", "parent, code"): 1,  # keys with a null don't collide
        ("children", "not null", "code"): 2,
        ("children", "check", "amount"): 1,  # unknown is no violation
    }
    empty = {k: v.limit(0) for k, v in tables.items()}
    found = contracts.constraint_violations(empty, contracts.constraint_table(spark, declared))
    assert {r["violations"] for r in rows(found)} == {0}
    with pytest.raises(contracts.ContractError, match="missing"):
        contracts.constraint_violations(
            {"parents": parents}, contracts.constraint_table(
                spark, [("parents", "not null", ("nothing",), None)]))
