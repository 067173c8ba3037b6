"""Parquet tables partitioned by date or month."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.times import month_key
from wayfare.tables import LANDING_DATE


def write_partitioned(
    df: DataFrame,
    path: str,
    partition: str = "date",
    value: Column | None = None,
    mode: str = "append",
    sort: tuple[str, ...] = (),
    compression: str = "snappy",
    max_records_per_file: int = 0,
    clustered: bool = False,
) -> None:
    """Write Parquet below ``partition=...`` folders.

    ``mode="replace"`` overwrites only the partitions present in the data, so a job can run
    again for a day. Rows are rebalanced by partition first: each task writes few
    partitions, and Spark splits a partition that is too large for one task. Both need
    adaptive execution, which is on by default. ``clustered=True`` saves that shuffle where
    the input files already follow the partition. ``sort`` orders rows inside each file,
    which narrows the min/max ranges later filters skip by.
    """
    if value is not None:
        df = df.withColumn(partition, value)
    if not clustered:
        df = df.hint("rebalance", partition)
    if sort:
        df = df.sortWithinPartitions(partition, *sort)
    writer = df.write.option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    writer.partitionBy(partition).parquet(path)


def write_by_date(df: DataFrame, path: str, mode: str = "append", **options) -> None:
    """A table that has a ``date`` column, partitioned by it."""
    write_partitioned(df, path, "date", mode=mode, **options)


def land_by_date(trips: DataFrame, path: str, mode: str = "append", **options) -> None:
    """Raw trips rewritten below their pickup date, in pickup order inside each file."""
    pickup = "tpep_pickup_datetime"
    write_partitioned(
        trips, path, LANDING_DATE, F.to_date(pickup), mode, sort=(pickup,), **options
    )


def write_by_month(windows: DataFrame, path: str, mode: str = "append", **options) -> None:
    """Window rows below their month, so that old months can be dropped as folders."""
    month = month_key(F.col("window_start"))
    write_partitioned(
        windows, path, "month", month, mode, sort=("window_start",), **options
    )


def write_plain(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def remove_partitions(spark: SparkSession, path: str, partition: str, values: Iterable[str]) -> int:
    """Remove whole folders ``partition=value`` of a table; returns how many there were.

    Works on any file system that Spark reads. Readers of the table should list it anew.
    """
    removed = 0
    for value in values:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{partition}={value}")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        removed += bool(files.exists(folder) and files.delete(folder, True))
    return removed


def drop_old_months(spark: SparkSession, path: str, keep_from: str) -> int:
    """Retention of a table written by :func:`write_by_month`: months before ``yyyy-MM`` go.

    The months are read from the folders; no file is opened.
    """
    months = spark.read.parquet(path).select(F.col("month").cast("string").alias("m")).distinct()
    old = [row["m"] for row in months.where(F.col("m") < keep_from).orderBy("m").collect()]
    return remove_partitions(spark, path, "month", old)
