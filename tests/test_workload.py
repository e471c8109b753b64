"""Workload counted by resource and case, in tasks whose size follows the log."""

from __future__ import annotations

import pytest

from tracewright import ProcessLog, log
from tracewright.operators import performance


@pytest.mark.parametrize(("limit", "task_rows"), [(100_000, 250_000), (2, 3), (100_000, 3)])
def test_workload_is_counted_by_case_first(spark, small_events, monkeypatch, limit, task_rows):
    monkeypatch.setattr(log, "TASK_ROWS", task_rows)
    events = small_events.unionByName(small_events.where("case_id = 'K-9'").selectExpr(
        *[f"CAST(NULL AS STRING) {c}" if c == "case_id" else c for c in small_events.columns]))
    found = performance.resource_workload(ProcessLog(events, case_limit=limit))
    got = {r.resource_id: (r.event_count, r.case_count, round(r.processing_hours * 60, 6),
                           r.automated_rate, round(r.workload_share, 6)) for r in found.collect()}
    total = 4 * 4 + 7 * 30 + 12 + 4 * 2
    assert got == {
        "CLERK-2": (4, 3, 16.0, 0.0, round(16 / total, 6)),
        "LAB-5": (7, 2, 210.0, 0.0, round(210 / total, 6)),
        "LINE-1": (1, 1, 12.0, 0.0, round(12 / total, 6)),
        "ROBOT-3": (4, 3, 8.0, 1.0, round(8 / total, 6))}
