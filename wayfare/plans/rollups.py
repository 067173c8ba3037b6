"""Window tables that are kept up to date from stored parts.

Every load of trips leaves its mergeable parts of a minute below ``parts/window_date=.../load=<id>``.
Hours are merged from the minutes of their date, days from the hours. What has been merged is recorded
as (date, load, size and time of its files), so the dates to do are those with a load that the record
does not know: a late trip changes the hours and the day of its own date, and nothing else is read or
written. Trips are read once, when they are loaded.

Every step can be repeated: a load replaces its own folders, a date its own rows, and the record is
written last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions import measures as m
from wayfare.operators.filters import PICKUP
from wayfare.operators.summaries import BOUNDS, zone_window_measures, zone_window_partials
from wayfare.sinks.parquet import remove_partitions

WINDOW_DATE = "window_date"
MINUTES, HOURS, DAYS, RECORD = "parts", "hour_parts", "day_parts", "rolled"
_WIDTHS = {HOURS: "1 hour", DAYS: "1 day"}


def _write_dates(rows: DataFrame, path: str, *partitions: str) -> None:
    (
        rows.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def add_load(trips: DataFrame, base: str, load: str, nulls: str = "zero") -> None:
    """Store the minute parts of a load of trips. A load that comes again replaces its dates; those it
    has no trips of any more are removed."""
    parts = zone_window_partials(trips, "1 minute", PICKUP, nulls)
    dated = parts.withColumns({WINDOW_DATE: F.to_date("window.start"), "load": F.lit(load)})
    spark = trips.sparkSession
    before = {r[WINDOW_DATE] for r in _present(spark, base).where(F.col("load") == load).collect()}
    _write_dates(dated, f"{base}/{MINUTES}", WINDOW_DATE, "load")
    if before:
        now = dated.select(F.col(WINDOW_DATE).cast("string")).distinct()
        for date in before - {r[0] for r in now.collect()}:
            remove_partitions(spark, f"{base}/{MINUTES}/{WINDOW_DATE}={date}", "load", [load])


def _present(spark: SparkSession, base: str) -> DataFrame:
    """(window_date, load, files): the stored loads of each date; only folders are listed."""
    schema = f"{WINDOW_DATE} string, load string, files long"
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{base}/{MINUTES}")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return spark.createDataFrame([], schema)
    place = rf"{WINDOW_DATE}=([^/]+)/load=([^/]+)/"
    return (
        files.select(
            F.regexp_extract("path", place, 1).alias(WINDOW_DATE),
            F.regexp_extract("path", place, 2).alias("load"),
            F.xxhash64("path", "length", "modificationTime").alias("file"),
        )
        .where("load <> ''")
        .groupBy(WINDOW_DATE, "load")
        .agg(F.bit_xor("file").alias("files"))
    )


def _recorded(spark: SparkSession, base: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{WINDOW_DATE} string, load string, files long").parquet(f"{base}/{RECORD}")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return None


def dirty_dates(spark: SparkSession, base: str) -> list[str]:
    """Dates whose loads are not those that were merged last, in order."""
    present, recorded = _present(spark, base), _recorded(spark, base)
    if recorded is None:
        found = present.select(WINDOW_DATE)
    else:
        keys = [WINDOW_DATE, "load", "files"]
        new = present.join(recorded, keys, "left_anti").select(WINDOW_DATE)
        gone = recorded.join(present, keys, "left_anti").select(WINDOW_DATE)
        found = new.union(gone)
    return [r[0] for r in found.distinct().orderBy(WINDOW_DATE).collect()]


def refresh(spark: SparkSession, base: str, nulls: str = "zero") -> list[str]:
    """Merge the parts of the dirty dates into their hours and days; returns the dates.

    The record is taken before the parts are read, so a load that comes meanwhile stays dirty.
    """
    dates = dirty_dates(spark, base)
    if not dates:
        return dates
    present = _present(spark, base)
    state = [tuple(r) for r in present.where(F.col(WINDOW_DATE).isin(dates)).collect()]
    wanted = zone_window_measures(nulls)
    source = MINUTES
    for table, width in _WIDTHS.items():
        parts = _dates_of(spark, f"{base}/{source}", dates)
        merged = m.combine(parts, [f"window(window.start, '{width}') AS window", "zone_id"], wanted)
        _write_dates(merged.withColumn(WINDOW_DATE, F.to_date("window.start")), f"{base}/{table}", WINDOW_DATE)
        source = table
    gone = sorted(set(dates) - {r[0] for r in state})
    for table in _WIDTHS:
        remove_partitions(spark, f"{base}/{table}", WINDOW_DATE, gone)
    record = spark.createDataFrame(state, f"{WINDOW_DATE} string, load string, files long")
    record = record.withColumn("of_date", F.col(WINDOW_DATE))
    _write_dates(record, f"{base}/{RECORD}", "of_date")
    remove_partitions(spark, f"{base}/{RECORD}", "of_date", gone)
    return dates


def _dates_of(spark: SparkSession, path: str, dates: Sequence[str]) -> DataFrame:
    return spark.read.parquet(path).where(F.col(WINDOW_DATE).isin([F.lit(d).cast("date") for d in dates]))


def windows(spark: SparkSession, base: str, table: str = HOURS, nulls: str = "zero") -> DataFrame:
    """The rolled-up table as windows, like ``zone_window_stats`` over all trips."""
    return m.finish(spark.read.parquet(f"{base}/{table}"), ["zone_id", *BOUNDS], zone_window_measures(nulls))
