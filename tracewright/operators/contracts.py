"""Data contracts: one violation aggregate per table, first broken rule raised in order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.log import ProcessLog
from tracewright.model import CASE_COLUMNS, EVENT_COLUMNS, PRIORITIES, VENDOR_TIERS


class ContractError(ValueError):
    """An input table breaks its declared contract."""


@dataclass(frozen=True)
class Rule:
    """A count of offending rows or keys and the message if it is not zero."""

    name: str
    message: str
    count: Column


EVENT_NUMERICS = ("amount_usd", "processing_minutes")
CASE_NUMERICS = (
    "amount_usd", "event_count", "rework_count", "cycle_time_hours", "sla_target_hours"
)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def _timestamp(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def _number(df: DataFrame, name: str, kind: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        number = F.col(name).try_cast("double")
    else:
        number = F.col(name).cast("double")
    # NaN is a double but not a number, as text and as a value.
    number = F.when(~F.isnan(number), number)
    if kind == "double":
        return number
    return F.when(number == F.floor(number), number.try_cast(kind))


def _flag(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        text = F.lower(F.col(name))
        return F.when(text.isin("true", "1"), True).when(text.isin("false", "0"), False)
    return F.col(name).cast("boolean")


def typed_events(df: DataFrame) -> DataFrame:
    """Events with parsed columns; what cannot be parsed becomes null."""
    parsed = {
        "timestamp": _timestamp(df, "timestamp"),
        "event_index": _number(df, "event_index", "bigint"),
        "automated": _flag(df, "automated"),
        **{c: _number(df, c, "double") for c in EVENT_NUMERICS},
    }
    return df.withColumns(parsed)


def typed_cases(df: DataFrame) -> DataFrame:
    parsed = {
        "created_at": _timestamp(df, "created_at"),
        "completed_at": _timestamp(df, "completed_at"),
        "sla_breached": _flag(df, "sla_breached"),
        **{c: _number(df, c, "double") for c in CASE_NUMERICS},
        "event_count": _number(df, "event_count", "bigint"),
        "rework_count": _number(df, "rework_count", "bigint"),
    }
    return df.withColumns(parsed)


def _any(conditions) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | F.coalesce(condition, F.lit(False))
    return out


def _per_key(rules: list[Rule], keys: Sequence[str], df: DataFrame) -> DataFrame:
    """Rule counts per key, so that duplicate keys and row rules share one shuffle."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[r.count.alias(r.name) for r in rules]
    )


def _violations(rules: list[Rule], keys: Sequence[str], df: DataFrame) -> DataFrame:
    return _per_key(rules, keys, df).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        F.count_if(F.col("_rows") > 1).alias("duplicate_keys"),
        *[F.coalesce(F.sum(r.name), F.lit(0)).alias(r.name) for r in rules],
    )


# The rule messages below are what callers match on, in order of precedence.


def event_rules() -> list[Rule]:
    negative = _any(F.col(c) < 0 for c in EVENT_NUMERICS)
    unread = _any(F.col(c).isNull() for c in EVENT_NUMERICS)
    keys_null = _any(F.col(c).isNull() for c in ("case_id", "activity"))

    def count(condition):
        return F.count_if(condition)

    return [
        Rule("null_keys", "case_id and activity cannot contain null values", count(keys_null)),
        Rule("bad_timestamp", "timestamp contains invalid values",
             count(F.col("timestamp").isNull())),
        Rule("bad_event_index", "event_index contains invalid values",
             count(F.col("event_index").isNull())),
        Rule("duplicate_keys", "case_id and event_index must be unique", F.lit(0)),
        Rule("bad_numbers", "numeric event fields contain invalid values", count(unread)),
        Rule("negative_numbers", "numeric event fields cannot be negative", count(negative)),
        Rule("bad_flag", "automated contains invalid boolean values",
             count(F.col("automated").isNull())),
    ]


def case_rules() -> list[Rule]:
    negative = _any(F.col(c) < 0 for c in CASE_NUMERICS)
    unread = _any(F.col(c).isNull() for c in CASE_NUMERICS)
    return [
        Rule("duplicate_keys", "case_id must be unique in the case table", F.lit(0)),
        Rule("bad_created_at", "created_at contains invalid values",
             F.count_if(F.col("created_at").isNull())),
        Rule("bad_completed_at", "completed_at contains invalid values",
             F.count_if(F.col("completed_at").isNull())),
        Rule("completed_first", "completed_at cannot precede created_at",
             F.count_if(F.col("completed_at") < F.col("created_at"))),
        Rule("bad_numbers", "case numeric fields contain invalid values", F.count_if(unread)),
        Rule("negative_numbers", "case numeric fields cannot be negative", F.count_if(negative)),
        Rule("bad_flag", "sla_breached contains invalid boolean values",
             F.count_if(F.col("sla_breached").isNull())),
    ]


def _rows_of(rules):
    return [r for r in rules if r.name != "duplicate_keys"]


def event_violations(typed: DataFrame) -> DataFrame:
    return _violations(_rows_of(event_rules()), ["case_id", "event_index"], typed)


def case_violations(typed: DataFrame) -> DataFrame:
    return _violations(_rows_of(case_rules()), ["case_id"], typed)


def _raise_first(found, rules: list[Rule], empty: str) -> None:
    if found["row_count"] == 0:
        raise ContractError(empty)
    for rule in rules:
        if found[rule.name]:
            raise ContractError(rule.message)


def validate_events(events: DataFrame, strict_order: bool = False) -> DataFrame:
    """Typed events, or :class:`ContractError` for the first broken rule.

    Row order is not part of a DataFrame: operators sort by
    ``(case_id, timestamp, event_index)`` themselves. ``strict_order`` also rejects logs
    whose timestamps go back in event order.
    """
    missing = missing_columns(events, EVENT_COLUMNS)
    if missing:
        raise ContractError(f"event log is missing required columns: {missing}")
    typed = typed_events(events)
    _raise_first(
        event_violations(typed).first(), event_rules(),
        "event log must contain at least one event",
    )
    if strict_order and not timestamp_regressions(typed).isEmpty():
        raise ContractError("timestamps must be monotonic within each case")
    return typed


def validate_cases(cases: DataFrame) -> DataFrame:
    missing = missing_columns(cases, CASE_COLUMNS)
    if missing:
        raise ContractError(f"case table is missing required columns: {missing}")
    typed = typed_cases(cases)
    _raise_first(
        case_violations(typed).first(), case_rules(),
        "case table must contain at least one case",
    )
    return typed


def case_count_comparison(events: DataFrame, cases: DataFrame) -> DataFrame:
    """``case_id, observed, declared, in_events, in_cases`` from one join by case."""
    observed = events.groupBy("case_id").agg(F.count(F.lit(1)).alias("observed"))
    declared = cases.select("case_id", F.col("event_count").alias("declared"),
                            F.lit(True).alias("in_cases"))
    return observed.join(declared, "case_id", "full_outer").select(
        "case_id", "observed", "declared",
        F.col("observed").isNotNull().alias("in_events"),
        F.coalesce("in_cases", F.lit(False)).alias("in_cases"),
    )


def case_set_difference(events: DataFrame, cases: DataFrame) -> DataFrame:
    """Cases that only one side has: ``case_id, missing_from``."""
    compared = case_count_comparison(events, cases)
    side = F.when(~F.col("in_cases"), "cases").otherwise("events")
    return compared.where(~F.col("in_cases") | ~F.col("in_events")).select(
        "case_id", side.alias("missing_from")
    )


def count_mismatches(events: DataFrame, cases: DataFrame) -> DataFrame:
    """Cases on both sides whose observed and declared event counts differ."""
    compared = case_count_comparison(events, cases)
    return compared.where(
        F.col("in_cases") & F.col("in_events") & ~F.col("observed").eqNullSafe(F.col("declared"))
    ).select("case_id", "observed", "declared")


def reconcile(events: DataFrame, cases: DataFrame) -> None:
    """Both tables must hold the same cases with the declared event counts."""
    compared = case_count_comparison(events, cases)
    found = compared.agg(
        F.count_if(~F.col("in_cases")).alias("not_in_cases"),
        F.count_if(~F.col("in_events")).alias("not_in_events"),
        F.count_if(~F.col("observed").eqNullSafe(F.col("declared"))).alias("count_differs"),
    ).first()
    if found["not_in_cases"] or found["not_in_events"]:
        def first_ids(side):
            rows = compared.where(~F.col(side)).orderBy("case_id").limit(5)
            return [r["case_id"] for r in rows.select("case_id").collect()]

        raise ContractError(
            "event and case identifiers differ: "
            f"missing_from_cases={first_ids('in_cases')}, "
            f"missing_from_events={first_ids('in_events')}"
        )
    if found["count_differs"]:
        raise ContractError("event_count does not reconcile to the event log")


def load(events: DataFrame, cases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Validate both scans and reconcile them."""
    checked = validate_events(events), validate_cases(cases)
    reconcile(*checked)
    return checked


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def null_required(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null and blank counts of required columns, one row per column."""
    counts = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(F.col(c).isNull()).alias("null_count"),
            F.count_if(F.trim(F.col(c).cast("string")) == "").alias("blank_count"),
        )
        for c in columns
    ]
    return events.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def timestamp_regressions(
    events: DataFrame, order: Sequence[str] = ("event_index",)
) -> DataFrame:
    """Events that are earlier than the event before them in event order."""
    log = ProcessLog(events, tuple(order))
    rows = log.linked("case_id", "event_index", "timestamp", previous=("timestamp",))
    earlier = F.col("before.timestamp")
    return rows.where(F.col("timestamp") < earlier).select(
        "case_id", "event_index", "timestamp", earlier.alias("previous_timestamp")
    )


def domain_violations(cases: DataFrame) -> DataFrame:
    """Counts of case rows outside the table's CHECK constraints."""
    return cases.agg(
        F.count_if(~F.col("vendor_tier").isin(*VENDOR_TIERS)).alias("vendor_tier"),
        F.count_if(~F.col("priority").isin(*PRIORITIES)).alias("priority"),
        F.count_if(F.col("event_count") <= 0).alias("event_count"),
        F.count_if(F.col("rework_count") < 0).alias("rework_count"),
        F.count_if(F.col("amount_usd") < 0).alias("amount_usd"),
        F.count_if(F.col("cycle_time_hours") < 0).alias("cycle_time_hours"),
        F.count_if(F.col("sla_target_hours") <= 0).alias("sla_target_hours"),
    )


@dataclass(frozen=True)
class Constraint:
    """A row of the constraint table. ``condition`` is the SQL of a check, or for a foreign key the
    parent as ``table(column, ...)``; a check holds where its condition is unknown."""

    table: str
    kind: str
    columns: tuple[str, ...]
    condition: str | None = None

    @property
    def parent(self) -> tuple[str, list[str]]:
        name, _, rest = self.condition.partition("(")
        return name.strip(), [c.strip() for c in rest.rstrip(") ").split(",")]


CONSTRAINT_SCHEMA = "table string, kind string, columns array<string>, condition string"


def constraint_table(spark: SparkSession, constraints: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame([(t, k, list(c), x) for t, k, c, x in constraints], CONSTRAINT_SCHEMA)


def _own_violations(df: DataFrame, rules: list[tuple[int, Constraint]]) -> DataFrame:
    """``rule, violations`` of keys, null rules and checks of one table, from one expansion.

    A row contributes its key for each key rule, and for each broken row rule a mark; all of them
    are counted by (rule, key) on the map side, so the shuffle holds the distinct keys and one
    row per task for each row rule.
    """
    none = F.lit(None).cast("string")
    parts = []
    for i, rule in rules:
        key = F.to_json(F.struct(*[F.col(c) for c in rule.columns]), {"ignoreNullFields": "false"})
        null = _any(F.col(c).isNull() for c in rule.columns)
        if rule.kind in ("primary key", "unique"):
            # SQL holds keys with a null apart from each other; a primary key may not have one.
            parts.append(F.when(~null, F.struct(F.lit(i).alias("rule"), key.alias("key"))))
        broken = {
            "primary key": null, "not null": null, "unique": F.lit(False),
            "check": ~F.coalesce(F.expr(rule.condition), F.lit(True)) if rule.kind == "check" else None,
        }[rule.kind]
        parts.append(F.when(broken, F.struct(F.lit(i).alias("rule"), none.alias("key"))))
    counted = df.select(F.inline(F.array_compact(F.array(*parts)))).groupBy("rule", "key").agg(
        F.count(F.lit(1)).alias("n"))
    beyond = F.when(F.col("key").isNull(), F.col("n")).otherwise(F.col("n") - 1)
    return counted.groupBy("rule").agg(F.sum(beyond).alias("violations"))


def _orphans(child: DataFrame, parent: DataFrame, rule: int, columns: Sequence[str],
             keys: Sequence[str]) -> DataFrame:
    """``rule, violations``: child rows whose key, if it is whole, no parent row has."""
    names = [f"_k{i}" for i in range(len(columns))]
    held = child.select(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)])
    held = held.dropna().groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(*[F.col(c).alias(n) for c, n in zip(keys, names, strict=True)])
    lost = held.join(known, names, "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
        F.lit(rule).alias("rule"), "violations")


def constraint_violations(tables: dict[str, DataFrame], constraints: DataFrame) -> DataFrame:
    """Rows that break each constraint, zeros included: ``table, kind, columns, violations``.

    ``constraints`` has one row per constraint (``Constraint``); it is a declaration, read by the
    driver, and compiled into one aggregate per table and one anti-join per foreign key. A key
    counts its rows beyond the first of each, and for a primary key those with a null.
    """
    spark = constraints.sparkSession
    declared = [Constraint(r["table"], r["kind"], tuple(r["columns"]), r["condition"])
                for r in constraints.collect()]
    for rule in declared:
        absent = missing_columns(tables[rule.table], rule.columns)
        if absent:
            raise ContractError(f"{rule.table} is missing constrained columns: {absent}")
    numbered = list(enumerate(declared))
    parts = []
    for name in dict.fromkeys(rule.table for rule in declared):
        own = [x for x in numbered if x[1].table == name and x[1].kind != "foreign key"]
        if own:
            parts.append(_own_violations(tables[name], own))
    for i, rule in numbered:
        if rule.kind == "foreign key":
            parent, keys = rule.parent
            parts.append(_orphans(tables[rule.table], tables[parent], i, rule.columns, keys))
    rows = spark.createDataFrame(
        [(i, c.table, c.kind, ", ".join(c.columns)) for i, c in numbered],
        "rule int, table string, kind string, columns string")
    found = reduce(DataFrame.unionByName, parts)
    return rows.join(found, "rule", "left").select(
        "table", "kind", "columns", F.coalesce("violations", F.lit(0)).alias("violations"))


def quality_summary(events: DataFrame, variant_total: DataFrame | None = None) -> DataFrame:
    """The data-quality row: sizes, time span, duplicate keys, null required fields."""
    per_key = events.groupBy("case_id", "event_index").agg(F.count(F.lit(1)).alias("n"))
    duplicates = per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).scalar()

    def distinct(column):
        # A scan of one column; each label set is combined before the shuffle.
        return events.select(F.count_distinct(column)).scalar()

    nulls = sum(
        (F.count_if(F.col(c).isNull()) for c in ("case_id", "activity", "timestamp")),
        start=F.lit(0),
    )
    base = events.agg(
        F.count(F.lit(1)).alias("event_count"),
        F.min("timestamp").alias("start_timestamp"),
        F.max("timestamp").alias("end_timestamp"),
        nulls.alias("null_required_fields"),
    )
    extra = [] if variant_total is None else [variant_total.scalar().alias("variant_count")]
    return base.select(
        "event_count",
        distinct("case_id").alias("case_count"),
        distinct("activity").alias("activity_count"),
        distinct("resource_id").alias("resource_count"),
        *extra,
        "start_timestamp", "end_timestamp",
        duplicates.alias("duplicate_case_event_keys"),
        "null_required_fields",
    )


def golden_check(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Metrics (``metric, value``) against expected values with an absolute tolerance."""
    joined = expected.join(actual, "metric", "left")
    return joined.select(
        "metric", "expected", "value", "tolerance",
        F.coalesce(F.abs(F.col("value") - F.col("expected")) <= F.col("tolerance"), F.lit(False))
        .alias("passed"),
    )


def model_coverage(nodes: DataFrame, ideal: DataFrame) -> DataFrame:
    """Activities of the ideal process (one row of ``activities``) without a BPMN task."""
    steps = ideal.select(F.explode("activities").alias("activity")).distinct()
    tasks = nodes.where("is_task").select(F.col("name").alias("activity"))
    return steps.join(tasks, "activity", "left_anti")


# High-confidence secret patterns by label.
SECRET_PATTERNS = {
    "AWS access key": r"\bAKIA[0-9A-Z]{16}\b",
    "GitHub token": r"\bgh[pousr]_[A-Za-z0-9]{36,255}\b",
    "private key": r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
    "Slack token": r"\bxox[baprs]-[A-Za-z0-9-]{20,}\b",
}


def secret_findings(
    texts: DataFrame, doc: str, text: str = "text", patterns: dict[str, str] = SECRET_PATTERNS,
) -> DataFrame:
    """``doc, label`` for each pattern a whole text matches; one pass over the texts."""
    hits = F.array(*[
        F.when(F.col(text).rlike(pattern), F.lit(label))
        for label, pattern in patterns.items()
    ])
    return texts.select(F.col(doc).alias("doc"), F.explode(F.array_compact(hits)).alias("label"))


def secret_summary(
    texts: DataFrame, text: str = "text", patterns: dict[str, str] = SECRET_PATTERNS,
) -> DataFrame:
    """Findings per pattern, zeros included, and the number of texts scanned."""
    counts = [
        F.struct(
            F.lit(label).alias("label"),
            F.count_if(F.col(text).rlike(pattern)).alias("finding_count"),
            F.count(F.lit(1)).alias("scanned"),
        )
        for label, pattern in patterns.items()
    ]
    return texts.agg(F.array(*counts).alias("c")).select(F.inline("c"))
