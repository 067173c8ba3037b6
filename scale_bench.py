"""Time the summaries over many trips in many files, a third of them in one zone and one hour.

    python scale_bench.py [ROWS] [FOLDER]

Writes the trips once (32 files) below FOLDER, a new temporary folder by default, and prints
one JSON line with the seconds of each summary and of its longest task set.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bench import run_once, session  # noqa: E402

FILES = 32


def trips(spark: SparkSession, rows: int) -> DataFrame:
    hot = "id % 3 = 0"
    return spark.range(0, rows, numPartitions=FILES).selectExpr(
        f"""TIMESTAMP_NTZ'2024-01-01 08:00:00' + make_dt_interval(
              CASE WHEN {hot} THEN 0 ELSE CAST(id % 31 AS INT) END,
              CASE WHEN {hot} THEN 0 ELSE CAST(id % 24 AS INT) END,
              CAST(id % 60 AS INT)) AS tpep_pickup_datetime""",
        f"CASE WHEN {hot} THEN 7L ELSE id % 265 END AS PULocationID",
        "id % 261 AS DOLocationID",
        "id % 6 AS passenger_count",
        "(id % 1000) / 100.0D AS trip_distance",
        "(id % 7001) / 100.0D AS fare_amount",
        "(id % 9001) / 100.0D AS total_amount",
        "(id % 11) / 10.0D AS tip_amount",
        "id % 4 + 1 AS payment_type",
    ).selectExpr("*", "tpep_pickup_datetime + INTERVAL 9 MINUTES AS tpep_dropoff_datetime")


def main(rows: int, folder: str) -> None:
    spark = session(os.environ.get("BENCH_CPUS") or str(os.cpu_count()))
    from wayfare.operators import summaries
    from wayfare.sources.trips import enrich, read_trips

    path = f"{folder}/trips-{rows}"
    if not os.path.isdir(path):
        trips(spark, rows).write.parquet(path)
    read = lambda s, _: enrich(read_trips(s, path))
    wanted = {
        "daily_summary": summaries.daily_summary,
        "zone_window_1m": summaries.zone_window_stats,
        "route_analysis": summaries.route_analysis,
    }
    seconds = {}
    for name, summary in wanted.items():
        runs = [run_once(spark, lambda s, d, f=summary: f(read(s, d)), path) for _ in range(3)]
        seconds[name] = round(min(runs[1:]), 2)
    spark.stop()
    print(json.dumps({"rows": rows, "files": FILES, "seconds": seconds, "at": time.strftime("%F")}))


if __name__ == "__main__":
    count = int(sys.argv[1]) if len(sys.argv) > 1 else 20_000_000
    main(count, sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="wayfare-bench-"))
