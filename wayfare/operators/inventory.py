"""Row counts and ranges over tables and files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_inventory(tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Rows, earliest and latest entry per table, dates as text.

    ``tables`` maps a name to the table and its time column; without one the range reads
    "N/A".
    """
    parts = []
    for name, (df, time) in tables.items():
        low = F.min(time).cast("string") if time else F.lit("N/A")
        high = F.max(time).cast("string") if time else F.lit("N/A")
        parts.append(
            df.agg(
                F.count(F.lit(1)).alias("record_count"),
                low.alias("earliest_data"),
                high.alias("latest_data"),
            ).select(F.lit(name).alias("table_name"), "*")
        )
    return reduce(DataFrame.unionByName, parts)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, by name."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("table_name"), "*"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted).orderBy("table_name")


def dataset_profile(trips: DataFrame) -> DataFrame:
    """Rows, columns and pickup range of a trip table."""
    return trips.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(trips.columns)).alias("column_count"),
        F.min("tpep_pickup_datetime").alias("first_pickup"),
        F.max("tpep_pickup_datetime").alias("last_pickup"),
    )


def file_profile(scan: DataFrame) -> DataFrame:
    """Rows and bytes per file of a file-based DataFrame."""
    return scan.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("bytes"),
    ).agg(F.count(F.lit(1)).alias("row_count"))
