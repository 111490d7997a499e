"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Each query is planned and run
anew into a no-op sink: one warm-up, then the median of two runs.
"""

from __future__ import annotations

import contextlib
import json
import os
import statistics
import sys
import time

from meterlake.catalog.registry import QUERIES
from meterlake.plans.session import build_session

HEADLINE = [
    "clean_readings", "rolling_mean_var", "usage_ratios", "electrical_features", "blend_status", "anomaly_threshold",
    "classifier_metrics", "balanced_sample", "stratified_split_counts", "promote_candidate", "risk_scores", "risk_by_area",
    "efficiency_by_area", "consumer_profile", "profile_zscores", "segment_labels", "latest_per_meter", "overview",
    "consumption_by_area", "weather_impact", "tick_totals", "live_timeline", "theft_queue", "hotspots", "report_tables",
    "score_histogram", "weather_enrich", "data_summary", "demand_series", "lag_matrix", "baseline_forecast_a",
    "forecast_compare", "mean_shift", "ks_drift", "duplicate_keys", "top_reasons", "alert_feed", "alert_counts",
    "expected_load", "json_ingest",
]
# Fits, iterations and streams: one run, no warm-up.
HEAVY = ["isolation_forest_scores", "dbscan_clusters", "stream_hourly_demand", "stream_rolling_features"]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(cpus, int(cpus) if cpus.isdigit() else 8, "meterlake-bench")
    seconds: dict[str, float] = {}
    with contextlib.redirect_stdout(sys.stderr):
        for name in HEADLINE:
            run(spark, name, folder)
            seconds[name] = round(statistics.median(run(spark, name, folder) for _ in range(2)), 3)
        for name in HEAVY:
            seconds[name] = round(run(spark, name, folder), 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total query time", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
