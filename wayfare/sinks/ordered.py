"""Tables in the order of their readers: the newest or busiest rows from a few files.

Files hold ranges of the first column of an order, and a small table beside them says which. The first
``k`` rows need only the files that reach above the least value that ``k`` rows are known to have.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROWS, RANGES = "rows", "ranges"


def _order(columns: Sequence[str]) -> list[Column]:
    """``-name`` is descending. Nulls come last either way."""
    return [F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc_nulls_last(c) for c in columns]


def write_ordered(rows: DataFrame, path: str, order: Sequence[str], files: int | None = None) -> None:
    """Write rows in ranges of an order (``-name`` for a descending column), sorted in each file, and
    the range of its first column in each file. A table that is there is replaced.

    Spark samples the ranges, so files are about equally large; many rows with one first value are cut
    by the columns behind it. ``files`` is how many (the shuffle partitions by default).
    """
    keys = _order(order)
    ranged = rows.repartitionByRange(files, *keys) if files else rows.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{path}/{ROWS}")
    stored = rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/{ROWS}")
    lead = F.col(order[0].removeprefix("-"))
    ranges = stored.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.min(lead).alias("low"), F.max(lead).alias("high"), F.count(lead).alias("row_count")
    )
    ranges = ranges.withColumn("of", F.lit(order[0].removeprefix("-")))
    ranges.coalesce(1).write.mode("overwrite").parquet(f"{path}/{RANGES}")  # a row for each file


def _files_for(spark: SparkSession, path: str, order: Sequence[str], k: int) -> list[str] | None:
    """The files that the first ``k`` rows can be in; None if that may be any.

    In the order of their worst values, the files down to the one that completes ``k`` rows hold only
    values up to its worst; no row behind that value is among the first.
    """
    down = order[0].startswith("-")
    best, worst = ("high", "low") if down else ("low", "high")
    ranges = spark.read.parquet(f"{path}/{RANGES}").where("low IS NOT NULL")
    ranges = ranges.where(F.col("of") == order[0].removeprefix("-"))
    by_worst = F.desc(worst) if down else F.asc(worst)
    total = F.sum("row_count").over(Window.orderBy(by_worst, "file_path"))
    full = ranges.select(worst, total.alias("total")).where(F.col("total") >= k).orderBy("total").limit(1).collect()
    if not full:
        return None
    border = F.lit(full[0][worst])
    reaches = F.col(best) >= border if down else F.col(best) <= border
    return [r.file_path for r in ranges.where(reaches).select("file_path").collect()]


def first_rows(spark: SparkSession, path: str, order: Sequence[str], k: int) -> DataFrame:
    """The first ``k`` rows in an order. Few files are read if the table was written in this order, or one
    with the same first column; otherwise all are.

    Rows with a null in the first column come last. The driver gets the names of the files that are read.
    """
    everything = spark.read.parquet(f"{path}/{ROWS}")
    files = _files_for(spark, path, order, k) if k > 0 else None
    rows = everything if files is None else spark.read.schema(everything.schema).parquet(*files)
    return rows.orderBy(*_order(order)).limit(k)
