"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores. Every query is run to its last row into a null sink.
"""

from __future__ import annotations

import json
import os
import time

from tracklake.session import get_session
from tracklake.testbed.queries import QUERIES

HEADLINE = [
    "stg_listen",
    "stg_page_view",
    "stg_status",
    "stg_users",
    "dim_users",
    "dim_songs",
    "dim_locations",
    "dim_pages",
    "fact_listen",
    "fact_session",
    "fact_status_change",
    "daily_trending",
    "song_daily_performance",
    "user_behavior_daily",
    "user_listening_stats",
    "session_quality",
    "subscription_journey",
    "user_daily_activity",
    "load_listen_events",
    "dedup_row_number",
    "rank_within_day",
    "time_differences",
    "asof_listen",
    "tolerance_match_best",
    "merge_by_key_listens",
    "dq_unique_combo",
    "normalize_title",
    "string_decode",
    "batch_decode",
    "stream_dedup_watermark",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["daily_trending"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm the JVM, untimed
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
