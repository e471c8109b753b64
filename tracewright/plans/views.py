"""The reporting layer for SQL users: base tables, analytic views and reports.

Views are the operators' plans under a name, so a long case or a heavy group is split in SQL
as it is in Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracewright.log import ProcessLog
from tracewright.operators import discovery, performance
from tracewright.sources.sinks import relational_cases, relational_form

REPORTS = ("top_wait_transitions", "bu_sla_gap", "rework_concentration")


def register_views(spark: SparkSession, events: DataFrame, cases: DataFrame) -> None:
    """Make the tables, views and reports known to ``spark.sql`` for this session."""
    edges = discovery.directly_follows_view(ProcessLog(events))
    views = {
        "process_events": relational_form(events),
        "process_cases": relational_cases(cases),
        "vw_case_performance": performance.sla_consumption(cases),
        "vw_activity_performance": discovery.activity_view(events),
        "vw_sla_performance": performance.sla_monthly(cases),
        "vw_directly_follows": edges,
        "top_wait_transitions": discovery.top_wait_transitions(edges),
        "bu_sla_gap": performance.bu_sla_gap(cases),
        "rework_concentration": performance.rework_concentration(cases),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
