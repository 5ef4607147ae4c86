"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_REPEATS  timed runs per query; the median counts (default 3, after one warm-up)
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from ludolake.plans.catalog import QUERIES
from ludolake.session import build_session

HEADLINE = [
    "p5_price_band_summary", "a1_overview", "a15_top_games_by_activity", "a21_events_per_session",
    "a22_metrics_summary", "e7_alert_rows", "a28_cluster_profile", "c13_recommend_by_id",
    "c14_recommend_by_title", "j2_recommend_many", "t3_search_games", "t7_sample_per_cluster",
    "c8_calinski_harabasz", "n10_advanced_sentiment", "g2_profile_columns",
    "g9_catalog_report", "g10_mask_pii", "c2_cluster_fit", "c10_recommend_k", "s3_read_review_records",
    "r4_active_players_stream", "p10_impute_median", "g5_discover",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({"metric": "headline_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
