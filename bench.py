"""Time the headline queries: one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "top_n_per_group", "agg_group_basic", "total_by_customer", "top5_customers", "cohort_retention", "basket_pairs",
    "join_inner", "join_asof", "join_interval_overlap", "join_bought_a_not_b", "win_running_total", "win_lag_lead",
    "win_cume_dist", "win_ntile", "win_running_count", "win_rolling_calendar", "sessionize", "window_funnel", "fraud_velocity",
    "median_per_group", "iqr_outliers", "hierarchy_levels", "merge_upsert", "scd2_apply", "quality_report", "drift_psi",
    "word_count", "bm25", "knn_exact", "stream_tumbling",
]


def main() -> None:
    from tidewater.plans import QUERIES
    from tidewater.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    picked = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus=cpus, partitions=cpus)
    spark.sparkContext.setLogLevel("OFF")
    run = lambda name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in picked:
        run(name)  # the first run compiles code and warms the file cache
        start = time.perf_counter()
        run(name)
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_warm_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf"), "cpus": cpus}))


if __name__ == "__main__":
    main()
