"""Run-log monitoring: windowed run counts, alerts with hold time, latency and gauges.

Samples are first reduced to one row per minute (or window) with map-side combine. What
remains is bounded by the time span, so the ordered passes over it stay small however many
samples arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.log import ProcessLog

# Upper bounds of the duration histogram, seconds.
DURATION_BUCKETS = (
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
)
# Adherence bands, lower limits.
ADHERENCE_RED, ADHERENCE_ORANGE = 0.70, 0.85


def runs_by_window(runs: DataFrame, size: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Runs per status and window; works on a batch and on a stream with a watermark."""
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    return runs.groupBy(window.alias("w"), "status").agg(
        F.count(F.lit(1)).alias("runs")
    ).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "status", "runs",
    )


def _islands(rows: DataFrame, at: str, breaks: Column, by: Sequence[str]) -> DataFrame:
    """Number maximal runs of consecutive rows; ``breaks`` marks the first row of a run."""
    ordered = Window.partitionBy(*by).orderBy(at)  # one row per minute of a series
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = rows.withColumn("_new", breaks.cast("int"))
    return marked.withColumn("island", F.sum("_new").over(upto)).drop("_new")


def failure_alerts(
    runs: DataFrame, span_minutes: int = 15, hold_minutes: int = 2, by: Sequence[str] = (),
) -> DataFrame:
    """Alert spans of "a failure within the last ``span`` minutes, for ``hold`` minutes".

    Each failure keeps the condition true for the span, so failures at most a span apart
    are one alert. ``by`` keeps instances apart.
    """
    minute = F.date_trunc("minute", F.col("ts"))
    failures = runs.where("status = 'failure'").groupBy(*by, minute.alias("minute")).agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n")
    )
    span = F.expr(f"INTERVAL {int(span_minutes)} MINUTES")
    previous = F.lag("last").over(Window.partitionBy(*by).orderBy("minute"))
    breaks = previous.isNull() | (F.col("first") > previous + span)
    spans = _islands(failures, "minute", breaks, by).groupBy(*by, "island").agg(
        F.min("first").alias("condition_start"),
        (F.max("last") + span).alias("condition_end"),
        F.sum("n").alias("failures"),
    )
    hold = F.expr(f"INTERVAL {int(hold_minutes)} MINUTES")
    return spans.select(
        *by, "condition_start", "condition_end", "failures",
        (F.col("condition_start") + hold).alias("fired_at"),
    ).where(F.col("fired_at") < F.col("condition_end"))


def _newest(value: str | Column, frame: DataFrame) -> Column:
    """The last sample; of samples at one moment the one with the highest run id."""
    tie = ["run_id"] if "run_id" in frame.columns else []
    return F.max_by(value, F.struct("ts", *tie))


def hold_alerts(
    samples: DataFrame, value: str, threshold: float, hold_minutes: int, step: str = "minute",
    by: Sequence[str] = (),
) -> DataFrame:
    """Alert spans of "gauge below ``threshold`` for ``hold`` minutes".

    The gauge is scraped once per step: its last sample in that step counts. A run of low
    scrapes fires when it lasts for the hold time. ``by`` keeps instances apart.
    """
    scraped = samples.groupBy(*by, F.date_trunc(step, F.col("ts")).alias("at")).agg(
        _newest(value, samples).alias("value")
    )
    low = F.col("value") < threshold
    was_low = F.lag(low).over(Window.partitionBy(*by).orderBy("at"))
    runs = _islands(scraped, "at", ~was_low.eqNullSafe(low), by)
    spans = runs.where(low).groupBy(*by, "island").agg(
        F.min("at").alias("low_from"), F.max("at").alias("low_to"),
        F.count(F.lit(1)).alias("scrapes"), F.min("value").alias("lowest"),
    )
    held = F.unix_seconds("low_to") - F.unix_seconds("low_from")
    return spans.where(held >= hold_minutes * 60).select(
        *by, "low_from", "low_to", "scrapes", "lowest"
    )


def low_sessions(
    samples: DataFrame, value: str, threshold: float, hold_minutes: int,
    gap_seconds: Column | int = 90, by: Sequence[str] = ("instance",),
) -> DataFrame:
    """The same alert as sessions of low samples, for batches and for streams with a watermark.

    A session lasts while low samples follow each other within the gap, which may differ from sample to
    sample (a series scraped every minute needs less than two). A normal sample leaves such a gap, so
    it ends the session. On a stream, a session is emitted once the watermark passes its end, and
    its state is dropped.
    """
    gap = F.lit(gap_seconds) if isinstance(gap_seconds, int) else gap_seconds
    window = F.session_window("ts", F.make_interval(secs=gap))
    spans = samples.where(F.col(value) < threshold).groupBy(*by, window.alias("w")).agg(
        F.min("ts").alias("low_from"), F.max("ts").alias("low_to"),
        F.count(F.lit(1)).alias("samples"), F.min(value).alias("lowest"),
    )
    held = F.unix_seconds("low_to") - F.unix_seconds("low_from")
    return spans.where(held >= hold_minutes * 60).select(
        *by, "low_from", "low_to", "samples", "lowest"
    )


# --- cumulative counters --------------------------------------------------------------------


def counter_growth(
    samples: DataFrame, counters: Sequence[str], by: Sequence[str] = ("instance",),
    tie: str = "run_id",
) -> DataFrame:
    """``by``, ``ts`` and per counter what it grew by since the series' sample before.

    A counter that falls was reset: all it shows has grown since then. The first sample of a
    series has nothing to grow from. A counter may be an array, e.g. of histogram buckets; then any
    bucket that falls resets all. Series of any length are looked back through by ``ProcessLog``.
    """
    series = F.to_json(F.struct(*by), {"ignoreNullFields": "false"})
    log = ProcessLog(samples.select(
        *by, *counters, "ts", F.col("ts").alias("timestamp"), F.col(tie).alias("event_index"),
        series.alias("case_id")))
    rows = log.linked(*by, "ts", *counters, previous=tuple(counters))

    def grown(name):
        now, then = F.col(name), F.col(f"before.{name}")
        if samples.schema[name].dataType.typeName() == "array":
            reset = F.exists(F.zip_with(now, then, lambda x, y: x < y), lambda x: x)
            steps = F.zip_with(now, then, lambda x, y: x - y)
            zero = F.transform(now, lambda x: x - x)
        else:
            reset, steps, zero = now < then, now - then, now - now
        return F.when(F.col("before").isNull(), zero).when(reset, now).otherwise(steps)

    return rows.select(*by, "ts", *[grown(c).alias(c) for c in counters])


def _sliding(growth: DataFrame, sums: dict[str, Column], by: Sequence[str], span_minutes: int) -> DataFrame:
    """Sums over the ``span`` minutes before each full minute. Minutes are added up first, so what is
    multiplied by the span is one row per series and minute."""
    minute = F.date_trunc("minute", F.col("ts"))
    per_minute = growth.groupBy(*by, minute.alias("minute")).agg(
        *[F.sum(x).alias(name) for name, x in sums.items()])
    ends = F.sequence(F.lit(1), F.lit(span_minutes))
    spread = per_minute.withColumn("_ahead", F.explode(ends)).withColumn(
        "window_end", F.col("minute") + F.make_dt_interval(mins=F.col("_ahead")))
    return spread.groupBy(*by, "window_end").agg(*[F.sum(name).alias(name) for name in sums])


def counter_increase(
    samples: DataFrame, counter: str, span_minutes: int = 15, by: Sequence[str] = ("instance",),
    series: Sequence[str] = ("instance",), tie: str = "run_id",
) -> DataFrame:
    """Reset-aware increase of a counter over the last ``span`` minutes, at each minute where it is not zero.

    Growth between two samples belongs to the later one, so what grew since the last sample before
    the window is in it. ``series`` tells counters apart, ``by`` what they are summed to.
    """
    growth = counter_growth(samples, [counter], series, tie)
    table = _sliding(growth, {"increase": F.col(counter)}, by, span_minutes)
    return table.where("increase > 0")


def increase_alerts(increase: DataFrame, hold_minutes: int = 2, by: Sequence[str] = ("instance",)) -> DataFrame:
    """Runs of minutes with an increase, fired once they have lasted for the hold time."""
    before = F.lag("window_end").over(Window.partitionBy(*by).orderBy("window_end"))
    gap = F.unix_seconds("window_end") - F.unix_seconds(before)
    runs = _islands(increase, "window_end", before.isNull() | (gap > 60), by)
    spans = runs.groupBy(*by, "island").agg(
        F.min("window_end").alias("condition_start"), F.max("window_end").alias("condition_end"),
        F.max("increase").alias("highest"))
    hold = F.expr(f"INTERVAL {int(hold_minutes)} MINUTES")
    return spans.select(
        *by, "condition_start", "condition_end", "highest",
        (F.col("condition_start") + hold).alias("fired_at"),
    ).where(F.col("fired_at") <= F.col("condition_end"))


def bucket_quantile(runs: Column, below: Column, quantile: float, buckets: Sequence[float]) -> Column:
    """Quantile of a cumulative histogram, interpolated inside its bucket; beyond the last
    finite bound it reports that bound."""
    rank = runs * F.lit(quantile)
    bounds = F.array(*[F.lit(float(b)) for b in buckets])
    # Position of the first bucket whose running count reaches the rank; -1 beyond the last.
    hit = F.size(F.filter(below, lambda c: c < rank))
    lower = F.when(hit == 0, 0.0).otherwise(F.get(bounds, hit - 1))
    under = F.when(hit == 0, 0).otherwise(F.get(below, hit - 1))
    inside = (rank - under) / (F.get(below, hit) - under)
    return F.when(hit == len(buckets), F.lit(float(buckets[-1]))).otherwise(
        lower + (F.get(bounds, hit) - lower) * inside
    )


def counter_quantile(
    samples: DataFrame, buckets_column: str, quantile: float = 0.95, span_minutes: int = 15,
    by: Sequence[str] = (), series: Sequence[str] = ("instance",),
    buckets: Sequence[float] = DURATION_BUCKETS, tie: str = "run_id",
) -> DataFrame:
    """Quantile from the growth of ``le`` bucket counters over the last ``span`` minutes.

    The counters of a sample are an array in the order of ``buckets``, the total behind them. Buckets
    grow per series, resets and all, and are then added up over ``by``.
    """
    growth = counter_growth(samples, [buckets_column], series, tie)
    names = [f"_b{i}" for i in range(len(buckets) + 1)]
    sums = {name: F.get(F.col(buckets_column), i) for i, name in enumerate(names)}
    table = _sliding(growth, sums, by, span_minutes).where(f"{names[-1]} > 0")
    runs, below = F.col(names[-1]), F.array(*names[:-1])
    return table.select(
        *by, "window_end", runs.alias("runs"),
        bucket_quantile(runs, below, quantile, buckets).alias("duration_quantile"))


def duration_quantile(
    runs: DataFrame, quantile: float = 0.95, size: str = "15 minutes",
    buckets: Sequence[float] = DURATION_BUCKETS,
) -> DataFrame:
    """Run duration quantile per window as a monitoring server reads it off a histogram.

    Counts per bucket are plain sums; the quantile is interpolated inside its bucket, and a
    quantile beyond the last finite bound reports that bound.
    """
    window = F.window("ts", size)
    counted = runs.groupBy(window.alias("w")).agg(
        F.count(F.lit(1)).alias("runs"),
        F.array(*[F.count_if(F.col("duration_seconds") <= b) for b in buckets]).alias("below"),
    )
    value = bucket_quantile(F.col("runs"), F.col("below"), quantile, buckets)
    return counted.select(
        F.col("w.start").alias("window_start"), "runs", value.alias("duration_quantile")
    )


def latest_gauges(samples: DataFrame) -> DataFrame:
    """The newest sample with a value of each gauge, all from one row, and the band of the adherence."""
    gauges = ("events_loaded", "cases_loaded", "sla_adherence")
    newest = samples.agg(_newest(F.struct("ts", *gauges), samples).alias("s")).select("s.*")
    adherence = F.col("sla_adherence")
    band = (
        F.when(adherence < ADHERENCE_RED, "red")
        .when(adherence < ADHERENCE_ORANGE, "orange").otherwise("green")
    )
    return newest.withColumn("adherence_band", band)


def run_record(runs_path: str, spark, *, status: str, seconds: float, events: int | None = None,
               cases: int | None = None, adherence: float | None = None) -> None:
    """Append one row to the run table."""
    from tracewright.model import RUN_SCHEMA

    row = spark.range(1).select(
        F.current_timestamp().alias("ts"), F.lit(status).alias("status"),
        F.lit(float(seconds)).alias("duration_seconds"),
        F.lit(events).cast("bigint").alias("events_loaded"),
        F.lit(cases).cast("bigint").alias("cases_loaded"),
        F.lit(adherence).cast("double").alias("sla_adherence"),
    )
    row.select(*RUN_SCHEMA.fieldNames()).write.mode("append").parquet(runs_path)
