"""Headline queries at one scale factor; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS timed runs after one warm-up (default 3, the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vitalmart.registry import QUERIES  # noqa: E402
from vitalmart.session import build_session  # noqa: E402

HEADLINE = [
    "v27_clinical_risk_distribution",      # three-layer scan, two-key cohort report
    "v29_glucose_analysis_trends",         # exact quartiles per band
    "v33_trends_timeseries",               # daily means, moving averages, trend
    "v21_demographic_health_profile",      # three keys, twenty measures
    "v36_population_health_dashboard",     # one-row population and cost
    "v38_alert_threshold_monitoring",      # four alerts in one pass
    "v40_model_drift_detection",           # per day means and deviations
    "s19_gold_compatibility",              # the full wide projection
    "i9_bronze_to_silver",                 # clean, cap, impute
    "x22_normalised_gold",                 # medians, scaling, scores, texts
    "x7_iqr_statistics",                   # five columns, exact quartiles, outliers
    "a2_grouped_rates",                    # two-key rates on the raw table
    "a9_exact_percentiles",                # percentiles of a wide-valued column
    "a21_multi_statistic_group_by",        # two keys, eight statistics
    "j1_incremental_anti_join",            # unseen keys
    "i2_upsert_by_key",                    # replace and add
    "d6_duplicate_full_rows",              # duplicates over all columns
    "t1_tumbling_hourly",                  # hourly windows over the event stream
    "v60_wearable_insights",               # cleaned table, cohort measures, exact medians
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for i in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(json.dumps({"metric": "headline queries, sum of medians", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
