from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tracewright.log import ProcessLog
from tracewright.model import IDEAL_PROCESS
from tracewright.operators import conformance, discovery, performance

# The published table of the fourteen traces with their case counts.
GOLDEN = Path(__file__).with_name("golden_variants.tsv")


@pytest.fixture(scope="module")
def golden_log(spark):
    """The published traces, each repeated for its cases, one hour between steps."""
    lines = [x.split("\t") for x in GOLDEN.read_text().splitlines()[1:]]
    traces = [(i, variant.split(" > "), int(n)) for i, (n, variant) in enumerate(lines)]
    table = spark.createDataFrame(traces, "trace int, steps array<string>, n int")
    cases = table.select("trace", "steps", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"))
    events = cases.select(
        F.concat_ws("-", F.col("trace").cast("string"), F.col("i").cast("string")).alias("case_id"),
        F.posexplode("steps").alias("event_index", "activity"),
    ).withColumn("timestamp", F.timestamp_seconds(F.col("event_index") * 3600))
    return ProcessLog(events.cache())


def test_golden_corpus(golden_log):
    assert (golden_log.facts.events, golden_log.facts.cases) == (166_551, 12_000)
    top = sorted(rows(discovery.variants(golden_log)), key=lambda r: r["variant_rank"])
    wanted = [x.split("\t") for x in GOLDEN.read_text().splitlines()[1:]]
    assert [(str(r["case_count"]), r["variant"]) for r in top] == [tuple(x) for x in wanted]
    arrays = conformance.conformance_arrays(golden_log, IDEAL_PROCESS)
    mean, straight = arrays.agg(
        F.avg("fitness"), F.avg(F.col("conformant").cast("int"))
    ).first()
    assert mean == pytest.approx(0.9162166, abs=1e-6)
    assert straight == pytest.approx(0.4231667, abs=1e-6)
    edges = {(r["source"], r["target"]): r["transition_count"]
             for r in rows(discovery.edge_counts(golden_log))}
    assert len(edges) == 31
    assert edges["Invoice Matched", "Payment Authorized"] == 12_634
    assert edges["Payment Executed", "Case Closed"] == 12_000


def test_golden_deviations_and_rework(golden_log):
    arrays = conformance.conformance_arrays(golden_log, IDEAL_PROCESS)
    found = {(r["deviation_type"], r["activity"]): r["case_count"]
             for r in rows(conformance.deviation_summary(arrays))}
    # Published deviation counts.
    assert found == {
        ("unexpected", "Delivery Delayed"): 1551, ("missing", "Manager Approval"): 1536,
        ("repeated", "Manager Approval"): 1259, ("unexpected", "Request Reworked"): 1259,
        ("unexpected", "Invoice Blocked"): 1159, ("unexpected", "Invoice Corrected"): 1159,
        ("unexpected", "Three-Way Match Failed"): 822,
        ("repeated", "Invoice Duplicate Check"): 744,
        ("unexpected", "Corrected Invoice Received"): 744,
        ("unexpected", "Duplicate Check Failed"): 744, ("unexpected", "Invoice Rejected"): 744,
        ("repeated", "Invoice Matched"): 634, ("repeated", "Payment Authorized"): 634,
        ("unexpected", "Payment Rejected"): 634,
    }
    repeats = {r["activity"]: r["repeat_events"]
               for r in rows(performance.rework_summary(golden_log.events))}
    assert repeats == {"Manager Approval": 1259, "Invoice Duplicate Check": 744,
                       "Invoice Matched": 634, "Payment Authorized": 634}


def test_explains_repetition(small_log):
    arrays = conformance.conformance_arrays(small_log, ("Intake", "Inspect", "Pack", "Ship"))
    table = {r["case_id"]: r for r in rows(conformance.conformance_cases(arrays))}
    assert [c for c, r in sorted(table.items()) if r["conformant"]] == ["K-7"]
    assert table["K-8"]["fitness"] == pytest.approx(1 / 2)
    assert table["K-9"]["repeated_activities"] == "Inspect"
    found = {(r["deviation_type"], r["activity"]): r["case_count"]
             for r in rows(conformance.deviation_summary(arrays))}
    assert found == {("repeated", "Inspect"): 1, ("missing", "Inspect"): 1, ("missing", "Pack"): 2}
    assert rows(conformance.conformance_split(arrays)) == [
        {"conformant_cases": 1, "nonconformant_cases": 2}
    ]
    assert conformance.deviation_summary(arrays.where("conformant")).count() == 0


def brute_distance(left, right):
    before = list(range(len(right) + 1))
    for i, a in enumerate(left, start=1):
        now = [i]
        for j, b in enumerate(right, start=1):
            now.append(min(now[-1] + 1, before[j] + 1, before[j - 1] + (a != b)))
        before = now
    return before[-1]


PAIRS = [([], []), (["a"], []), (["a"], ["a"]), (["a", "b"], ["a", "c"]), (["a"], ["a", "b"])]


def test_edit_distance_matches_brute_force(spark):
    rng = random.Random(5)
    labels = ["a", "b", "c", "ä", "long label"]
    pairs = PAIRS + [
        ([rng.choice(labels) for _ in range(rng.randrange(8))],
         [rng.choice(labels) for _ in range(rng.randrange(8))]) for _ in range(60)
    ]
    # Traces of more than one word of bits, on either side, with few and with many labels.
    for kinds in (2, 400):
        pairs += [([str(rng.randrange(kinds)) for _ in range(rng.choice([1, 61, 62, 63, 130]))],
                   [str(rng.randrange(kinds)) for _ in range(rng.choice([1, 61, 62, 63, 124, 187]))])
                  for _ in range(12)]
    pairs += [([], ["a"] * 70), (["a"] * 70, []), ([], []),]
    df = spark.createDataFrame(pairs, "l array<string>, r array<string>")
    out = df.select("l", "r", conformance.token_edit_distance(F.col("l"), F.col("r")).alias("d"))
    assert all(row.d == brute_distance(row.l, row.r) for row in out.collect())


def test_path_distance_with_repeats_matches_brute_force(spark):
    rng = random.Random(6)
    ideal = ["a", "b", "a", "c", "b"]
    traces = [[rng.choice("abcdx") for _ in range(rng.randrange(1, 9))] for _ in range(60)]
    df = spark.createDataFrame([(t,) for t in traces], "steps array<string>")
    found = conformance.deviations(F.col("steps"), ideal)
    out = df.select(
        "steps", conformance.edit_distance(F.col("steps"), ideal).alias("d"),
        *[c.alias(n) for n, c in found.items()],
    )
    need = {"a": 2, "b": 2, "c": 1}
    for row in out.collect():
        assert row.d == brute_distance(row.steps, ideal)
        assert row.missing == [a for a in need if row.steps.count(a) < need[a]]
        assert row.unexpected == sorted(set(row.steps) - set(need))
        assert row.repeated == sorted(
            a for a in set(row.steps) if row.steps.count(a) > max(1, need.get(a, 0))
        )
