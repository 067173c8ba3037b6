"""Time the headline queries; prints one JSON line.

All queries run once to warm up, then three times; the median counts. Every row is
materialized by the noop sink. Streams are timed from start to the last stored row. Beside the
headline queries, which make up the value, it times parsing alone over stored message texts, and
summaries over the events repeated in 32 files.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "daily_summary",
    "daily_summary_for_date",
    "hourly_zone_stats",
    "zone_window_1m",
    "zone_hour_from_minute_partials",
    "global_window_1m",
    "route_analysis",
    "top_routes",
    "top_active_zones",
    "recent_windows_24h",
    "daypart_profile",
    "valid_trips",
    "json_trips",
    "payment_class_counts",
    "grid_zones",
    "constraint_report",
    "merge_replace",
    "merge_partial",
    "replay_schedule",
    "stream_zone_window",
)
RUNS = 3
FILES = 32


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wayfare bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepared(spark: SparkSession, sf_dir: str, folder: str) -> dict:
    """Queries over stored inputs: message texts, and 32 files of events."""
    from wayfare.operators import summaries
    from wayfare.sources import messages, sample
    from wayfare.sources.trips import enrich

    events = sample.read_events(spark, sf_dir)
    sample.as_messages(events).repartition(8).write.parquet(f"{folder}/texts")
    for _ in range(FILES):
        events.write.mode("append").parquet(f"{folder}/events.parquet")

    def parsed(spark: SparkSession, _: str):
        return messages.usable(messages.parse_messages(spark.read.parquet(f"{folder}/texts")))

    def over_files(summary):
        def run(spark: SparkSession, _: str):
            return summary(enrich(sample.as_raw_trips(sample.read_events(spark, folder), True)))

        return run

    return {
        "parse_stored_messages": parsed,
        "daily_summary_32_files": over_files(summaries.daily_summary),
        "zone_window_1m_32_files": over_files(summaries.zone_window_stats),
    }


def run_once(spark: SparkSession, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = session(cpus)
    from wayfare.plans.queries import QUERIES

    with tempfile.TemporaryDirectory(prefix="wayfare-bench-") as folder:
        timed = {name: QUERIES[name] for name in HEADLINE} | prepared(spark, sf_dir, folder)
        runs: dict[str, list[float]] = {name: [] for name in timed}
        for _ in range(1 + RUNS):
            for name, query in timed.items():
                runs[name].append(run_once(spark, query, sf_dir))
        spark.stop()
    seconds = {name: statistics.median(times[1:]) for name, times in runs.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds[name] for name in HEADLINE), 4),
                "unit": "sec",
                "queries": {name: round(s, 4) for name, s in seconds.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
