"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores, and
``BENCH_QUERIES`` an optional comma-separated choice of registered queries.
"""

from __future__ import annotations

import json
import os
import time

from tracewright.plans.queries import registry
from tracewright.session import build_session

HEADLINE = (
    "variants", "case_sequences", "dfg", "dfg_view", "activity_summary", "start_end_activities",
    "conformance_cases", "deviations", "transition_waits", "bottlenecks", "case_performance",
    "rework", "resource_workload", "segment_sla", "case_enriched", "kpis", "sla_features_clicks",
    "dq_violations", "dq_ts_regression", "dq_count_reconcile", "dq_secret_scan",
    "whatif_observed", "scenario_outcomes", "measures_by_slicer", "measures_cube",
    "runs_by_window", "alert_failures", "alert_hold_adherence", "duration_p95",
    "order_activities", "variants_orders", "dfg_orders", "temporal_split",
    "baseline_metrics", "sla_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()

    def run(name: str) -> float:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    run("dfg")  # warms the JVM up; not counted
    seconds = {name: round(run(name), 3) for name in names}
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
