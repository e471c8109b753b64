from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tracewright.model import RUN_SCHEMA
from tracewright.operators import monitoring
from tracewright.streaming import runs as streaming


def at(minute: float) -> dt.datetime:
    return dt.datetime(2026, 3, 1, tzinfo=dt.UTC) + dt.timedelta(minutes=minute)


def sample(minute, status="success", seconds=0.2, events=166_551, adherence=0.9):
    return (at(minute), status, float(seconds), events, 12_000, adherence)


@pytest.fixture(scope="module")
def runs(spark):
    data = [sample(m) for m in range(0, 100, 5)]
    data += [sample(m, "failure", 3.0) for m in (12, 20, 70)]  # two bursts
    data += [sample(m, events=50) for m in range(41, 54)]  # 12 minutes of low volume
    data += [sample(m, adherence=0.65) for m in range(101, 137)]  # 35 minutes below target
    return spark.createDataFrame(data, RUN_SCHEMA).cache()


def test_windows(runs):
    table = {(r["window_start"].hour, r["status"]): r["runs"]
             for r in rows(monitoring.runs_by_window(runs))}
    assert table[0, "failure"] == 2
    assert table[1, "failure"] == 1
    assert sum(table.values()) == runs.count()


def test_failure_alert(runs):
    alerts = monitoring.failure_alerts(runs).orderBy("fired_at").select(
        F.unix_seconds("fired_at"), F.unix_seconds("condition_end"), "failures").collect()
    start = int(at(0).timestamp())
    assert [((a - start) // 60, (b - start) // 60, n) for a, b, n in alerts] == [
        (14, 35, 2), (72, 85, 1)]


def test_hold_alerts(runs):
    # The normal samples in between break the run of low volume, unless they are left out.
    steady = runs.where("minute(ts) % 5 <> 0 or events_loaded < 100000")
    volume = rows(monitoring.hold_alerts(steady, "events_loaded", 100_000, 10))
    assert [r["lowest"] for r in volume] == [50]
    assert rows(monitoring.hold_alerts(steady, "events_loaded", 100_000, 13)) == []
    dips = rows(monitoring.hold_alerts(runs, "sla_adherence", 0.70, 30))
    assert [r["scrapes"] for r in dips] == [36]


def test_duration_quantile(spark):
    data = [sample(0, seconds=s) for s in [0.004] * 10 + [0.3] * 80 + [4.0] * 10]
    data += [sample(20, seconds=99.0)]
    df = spark.createDataFrame(data, RUN_SCHEMA)
    table = sorted(rows(monitoring.duration_quantile(df)), key=lambda r: r["window_start"])
    # Rank 95 lies half way through the ten runs of the bucket from 2.5 to 5 seconds.
    assert table[0]["duration_quantile"] == pytest.approx(2.5 + 2.5 * 0.5)
    assert table[1]["duration_quantile"] == 10.0


def test_gauges(runs):
    row = rows(monitoring.latest_gauges(runs))[0]
    assert row["sla_adherence"] == 0.65
    assert row["adherence_band"] == "red"


def test_run_record(spark, tmp_path):
    path = str(tmp_path / "runs")
    monitoring.run_record(path, spark, status="success", seconds=1.5, events=7, cases=2,
                          adherence=0.5)
    monitoring.run_record(path, spark, status="failure", seconds=0.1)
    table = spark.read.schema(RUN_SCHEMA).parquet(path)
    assert {(r["status"], r["events_loaded"]) for r in rows(table)} == {
        ("success", 7), ("failure", None)}


def test_stream_equals_batch(spark, runs, tmp_path):
    source = str(tmp_path / "in")
    runs.repartition(3).write.parquet(source)
    # A late end marker lets the watermark pass the last real window.
    spark.createDataFrame([sample(600)], RUN_SCHEMA).write.mode("append").parquet(source)
    stream = streaming.runs_by_window_stream(streaming.read_runs(spark, source))
    query = streaming.write_table(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination(120)
    got = {(r["window_start"], r["status"], r["runs"])
           for r in rows(spark.read.parquet(str(tmp_path / "out")))}
    want = {(r["window_start"], r["status"], r["runs"])
            for r in rows(monitoring.runs_by_window(runs))}
    assert got == want


def test_sliding_failures(spark, runs, tmp_path):
    source = str(tmp_path / "in")
    runs.write.parquet(source)
    stream = streaming.failure_rate_stream(streaming.read_runs(spark, source))
    query = stream.writeStream.format("memory").queryName("failing").outputMode("update").trigger(
        availableNow=True).start()
    query.awaitTermination(120)
    assert spark.table("failing").agg(F.max("runs")).first()[0] == 2


def brute_growth(series):
    """Growth of a list of (ts, value), resets included."""
    out, before = [], None
    for ts, value in sorted(series):
        out.append((ts, 0 if before is None else value if value < before else value - before))
        before = value
    return out


def test_counters_survive_resets(spark):
    import random

    rng = random.Random(4)
    data, series = [], {}
    for name in ("a", "b", "hot"):
        value, buckets = 0, [0, 0, 0]
        for i in range(400 if name == "hot" else 60):
            if rng.random() < 0.05:
                value, buckets = 0, [0, 0, 0]  # a restart
            value += rng.choice([0, 0, 1, 5])
            buckets = [x + k for x, k in zip(buckets, rng.choice([(0, 0, 1), (0, 1, 1), (1, 1, 1)]), strict=True)]
            data.append((name, at(i * 0.4), i, value, list(buckets)))
            series.setdefault(name, []).append((at(i * 0.4), value))
    samples = spark.createDataFrame(
        data, "instance string, ts timestamp, run_id int, failures long, durations array<long>")
    wanted = {}
    for name, values in series.items():
        for ts, grown in brute_growth(values):
            minute = int((ts - at(0)).total_seconds() // 60)
            for k in range(1, 16):
                wanted[name, minute + k] = wanted.get((name, minute + k), 0) + grown
    wanted = {k: v for k, v in wanted.items() if v}
    table = monitoring.counter_increase(samples, "failures")
    start = int(at(0).timestamp())
    found = {(r.instance, (int(r.window_end.timestamp()) - start) // 60): r.increase
             for r in table.withColumn("window_end", F.col("window_end")).collect()}
    assert found == wanted
    alerts = rows(monitoring.increase_alerts(table))
    assert alerts and all(r["fired_at"] <= r["condition_end"] for r in alerts)
    # Buckets 1 s and 2 s; the total is what lies beyond.
    quantiles = rows(monitoring.counter_quantile(samples, "durations", 0.5, buckets=(1.0, 2.0)))
    assert quantiles and all(0 <= r["duration_quantile"] <= 2 for r in quantiles)
    grown = monitoring.counter_growth(samples, ["durations"]).collect()
    assert sum(r.durations[2] for r in grown) == len(data) - 3  # one run a sample; the first ones start


def test_low_sessions_match_the_scraped_alert(runs):
    """Samples once a minute: a session of low samples is a run of low scrapes."""
    by_minute = runs.where("status = 'success'").withColumn("instance", F.lit("x"))
    sessions = rows(monitoring.low_sessions(by_minute, "sla_adherence", 0.70, 30))
    alerts = rows(monitoring.hold_alerts(by_minute, "sla_adherence", 0.70, 30, by=["instance"]))
    assert [(r["low_from"], r["low_to"], r["lowest"]) for r in sessions] == [
        (r["low_from"], r["low_to"], r["lowest"]) for r in alerts]
    assert len(sessions) == 1


def test_hold_alerts_on_a_stream(spark, tmp_path):
    """Each alert once, late rows within the watermark counted, rows behind it left out."""
    schema = "instance string, ts timestamp, sla_adherence double"

    def low(instance, minutes):
        return [(instance, at(m), 0.5) for m in minutes]

    batches = [
        low("a", range(0, 20)) + low("b", [*range(0, 5), *range(9, 50)]) + [("a", at(55), 0.9)],
        low("a", range(20, 40)) + [("c", at(58), 0.9)],  # late: the session of a goes on
        [("a", at(200), 0.9), ("b", at(200), 0.4)],
        low("b", [51, 52]),  # behind the watermark
        [("a", at(400), 0.9), ("b", at(400), 0.4)],
    ]
    source = tmp_path / "in"
    source.mkdir()
    stream = streaming.hold_alerts_stream(
        spark.readStream.schema(schema).parquet(str(source)), "sla_adherence", 0.7, 30, late="60 minutes")
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(source))
        query = streaming.write_table(stream, str(tmp_path / "out"), str(tmp_path / "check"))
        query.awaitTermination(120)
    got = sorted((r["instance"], r["samples"]) for r in rows(spark.read.parquet(str(tmp_path / "out"))))
    assert got == [("a", 40), ("b", 41)]
    kept = [r for i, b in enumerate(batches) for r in b if i != 3]
    batch = monitoring.low_sessions(spark.createDataFrame(kept, schema), "sla_adherence", 0.7, 30)
    assert sorted((r["instance"], r["samples"]) for r in rows(batch)) == got


def test_gauges_of_one_moment(spark):
    tied = spark.createDataFrame(
        [(at(1), i, i * 10, i * 100, i / 10) for i in (3, 9, 5)],
        "ts timestamp, run_id int, events_loaded int, cases_loaded int, sla_adherence double")
    row = rows(monitoring.latest_gauges(tied))[0]
    assert (row["events_loaded"], row["cases_loaded"], row["sla_adherence"]) == (90, 900, 0.9)
