"""Data model: table schemas and the governed constants of the purchase-to-pay process."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the two input tables.
EVENT_COLUMNS = (
    "case_id", "event_index", "activity", "timestamp", "resource_id", "resource_role",
    "business_unit", "department", "country", "vendor_id", "vendor_tier",
    "material_category", "amount_usd", "priority", "channel", "automated",
    "processing_minutes", "source_system",
)
CASE_COLUMNS = (
    "case_id", "created_at", "completed_at", "business_unit", "department", "country",
    "vendor_id", "vendor_tier", "material_category", "amount_usd", "priority", "channel",
    "variant_ground_truth", "event_count", "rework_count", "cycle_time_hours",
    "sla_target_hours", "sla_breached",
)
RESOURCE_COLUMNS = ("resource_id", "resource_role", "team", "fte_capacity", "hourly_cost_usd")

_TYPES = {
    "event_index": T.IntegerType(), "event_count": T.IntegerType(),
    "rework_count": T.IntegerType(), "fte_capacity": T.IntegerType(),
    "hourly_cost_usd": T.IntegerType(),
    "timestamp": T.TimestampType(), "created_at": T.TimestampType(),
    "completed_at": T.TimestampType(),
    "amount_usd": T.DoubleType(), "processing_minutes": T.DoubleType(),
    "cycle_time_hours": T.DoubleType(), "sla_target_hours": T.DoubleType(),
    "automated": T.BooleanType(), "sla_breached": T.BooleanType(),
}


def _schema(columns):
    return T.StructType([T.StructField(c, _TYPES.get(c, T.StringType())) for c in columns])


def raw_schema(columns):
    """All-string schema, so that the contract rules see the text as it was written."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


EVENT_SCHEMA = _schema(EVENT_COLUMNS)
CASE_SCHEMA = _schema(CASE_COLUMNS)
RESOURCE_SCHEMA = _schema(RESOURCE_COLUMNS)

IDEAL_PROCESS_SCHEMA = T.StructType([
    T.StructField("process", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("activities", T.ArrayType(T.StringType())),
    T.StructField("sla_targets_hours", T.MapType(T.StringType(), T.DoubleType())),
])

RUN_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("events_loaded", T.LongType()),
    T.StructField("cases_loaded", T.LongType()),
    T.StructField("sla_adherence", T.DoubleType()),
])

# The designed path, in order.
IDEAL_PROCESS = (
    "Purchase Request Created", "Manager Approval", "Procurement Review",
    "Purchase Order Created", "Purchase Order Sent", "Supplier Confirmation",
    "Goods Received", "Invoice Received", "Invoice Duplicate Check", "Invoice Matched",
    "Payment Authorized", "Payment Executed", "Case Closed",
)
# Steps a system performs without a person.
AUTOMATED_ACTIVITIES = (
    "Purchase Request Created", "Purchase Order Sent", "Invoice Duplicate Check",
    "Payment Executed", "Case Closed",
)
# SLA target in hours by priority.
SLA_TARGET_HOURS = {"Urgent": 120.0, "Standard": 240.0, "Strategic": 336.0}
# Allowed domain labels.
VENDOR_TIERS = ("A", "B", "C")
PRIORITIES = ("Urgent", "Standard", "Strategic")
# Fixed value: yearly case volume used for annualised figures.
ANNUAL_CASE_VOLUME = 8_000

# The constraints of the relational schema, as (table, kind, columns, condition or
# parent table). A key is unique and without nulls; a reference names the parent's key columns.
_CASE_CHECKS = {
    "vendor_tier": "vendor_tier IN ('A', 'B', 'C')", "amount_usd": "amount_usd >= 0",
    "priority": "priority IN ('Urgent', 'Standard', 'Strategic')", "event_count": "event_count > 0",
    "rework_count": "rework_count >= 0", "cycle_time_hours": "cycle_time_hours >= 0",
    "sla_target_hours": "sla_target_hours > 0",
}
SCHEMA_CONSTRAINTS = (
    ("process_cases", "primary key", ("case_id",), None),
    *(("process_cases", "not null", (c,), None) for c in CASE_COLUMNS),
    *(("process_cases", "check", (c,), condition) for c, condition in _CASE_CHECKS.items()),
    ("process_events", "primary key", ("case_id", "event_index"), None),
    ("process_events", "foreign key", ("case_id",), "process_cases(case_id)"),
    *(("process_events", "not null", (c,), None) for c in EVENT_COLUMNS),
    ("process_events", "check", ("processing_minutes",), "processing_minutes >= 0"),
)

# Roles of the activities that feed the SLA features.
DECISION_ACTIVITY = "Purchase Order Created"
APPROVAL_ACTIVITY = "Manager Approval"
REWORK_ACTIVITY = "Request Reworked"
