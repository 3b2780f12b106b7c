"""Seconds per query on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``: median of three runs after a warm-up.

Prints one JSON line. The streaming figure is events per second of a whole replay, start-up included.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from tidewatch.plans.queries import REGISTRY  # noqa: E402

BATCH = (
    "parse_events",
    "window_stats",
    "product_window_stats",
    "running_totals",
    "large_amount",
    "failed_surge",
    "ip_sharing",
    "high_frequency",
    "continuous_increase",
    "all_alerts",
    "top_risky_users",
    "alert_search",
    "stats_history",
    "enrich_transactions",
    "load_facts",
    "rejected_facts",
    "stored_top_risky_users",
    "orphan_report",
)
STREAMS = ("stream_window_totals", "stream_ip_sharing", "stream_high_frequency", "stream_continuous_increase")


def timed(spark: SparkSession, name: str, folder: str) -> float:
    begin = time.perf_counter()
    REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    memory = "16g"
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidewatch-bench")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidewatch-bench-"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in BATCH:
        timed(spark, name, folder)
        seconds[name] = round(statistics.median(timed(spark, name, folder) for _ in range(3)), 3)
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    rates = {}
    timed(spark, STREAMS[0], folder)
    for name in STREAMS:
        seconds[name] = round(timed(spark, name, folder), 3)
        rates[name] = round(events / seconds[name])
    print(
        json.dumps(
            {
                "metric": "total seconds of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "events": events,
                "stream_events_per_sec": rates,
                "cpus": int(cpus),
                "driver_memory": memory,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
