"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the local cores. Every
query runs once to warm up and then three times; the median counts. Queries that run streams write
before they return, so building the DataFrame is timed with them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from checks.shared import ensure_shared_folder  # noqa: E402
from visitlens.session import build_session  # noqa: E402

HEADLINE = (
    "area_top10_products", "job_area_top_products", "group_concat_distinct_count",
    "job_session_analysis", "session_length", "session_totals", "session_length_levels",
    "session_hour_lengths", "hour_session_count", "sample_sessions", "session_sample_detail",
    "hour_top5_sessions", "explode_category_actions", "top10_categories",
    "top10_category_sessions", "top_session_details", "filter_actions_by_task",
    "scan_action_log", "parse_ad_click", "stream_user_clicks_window", "stream_blacklist_update",
    "ad_daily_counts", "province_top5_ads", "stream_ad_clicks_window", "stream_idle_expiry",
    "job_session_sampled_rows", "job_session_category_records", "job_ad_realtime", "stream_province_top5",
    "stream_checkpoint", "sink_upsert",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    partitions = cpus if cpus.isdigit() else "8"
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": partitions, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")

    ensure_shared_folder(spark)

    seconds = {}
    for name in names:
        times = []
        for _ in range(1 + RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(json.dumps({
        "metric": "total of median query times", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).lstrip("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
