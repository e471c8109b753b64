from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tracewright.log import ProcessLog
from tracewright.model import EVENT_SCHEMA
from tracewright.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def utc(day: int, hour: int) -> dt.datetime:
    return dt.datetime(2026, 1, day, hour, tzinfo=dt.UTC)


STAFF = {  # activity: resource, role, minutes of work, done by a machine
    "Intake": ("CLERK-2", "Clerk", 4.0, False), "Inspect": ("LAB-5", "Technician", 30.0, False),
    "Pack": ("LINE-1", "Packer", 12.0, False), "Ship": ("ROBOT-3", "Machine", 2.0, True),
}


@pytest.fixture(scope="session")
def small_events(spark):
    """Three repairs: K-7 takes every step once, K-8 is sent on at once, K-9 is inspected three
    times and never packed."""
    visits = [
        ("K-7", 3, "Intake", 8), ("K-7", 3, "Inspect", 9), ("K-7", 3, "Pack", 13),
        ("K-7", 3, "Ship", 14), ("K-8", 4, "Intake", 10), ("K-8", 4, "Ship", 20),
        ("K-9", 5, "Intake", 6), ("K-9", 5, "Inspect", 8), ("K-9", 5, "Inspect", 9),
        ("K-9", 5, "Inspect", 11), ("K-9", 5, "Ship", 16),
    ]
    seen: dict[str, int] = {}
    table = []
    for case, day, activity, hour in visits:
        seen[case] = seen.get(case, 0) + 1
        resource, role, minutes, machine = STAFF[activity]
        table.append((case, seen[case], activity, utc(day, hour), resource, role, "Repairs",
                      "Bench", "Chile", "S-204", "B", "Tools", 75.5, "Urgent", "Counter", machine,
                      minutes, "WMS"))
    return spark.createDataFrame(table, EVENT_SCHEMA).cache()


@pytest.fixture
def small_log(small_events):
    return ProcessLog(small_events)
