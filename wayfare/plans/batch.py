"""Batch jobs: trips from Parquet to a stored summary table.

    spark-submit --py-files wayfare.zip wayfare/plans/batch.py \\
        daily_summary --input PATH --output PATH 2024-01-05
    spark-submit --py-files wayfare.zip wayfare/plans/batch.py \\
        hourly_zone_stats --input PATH --output PATH --all-history

Without a date the job takes yesterday. Each job aggregates and writes in one action; a run
for a date replaces that date, so it can be repeated. Routes have no date: what is stored are
their mergeable parts for each date, which reading adds up.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators import summaries
from wayfare.operators.filters import on_day, split_invalid
from wayfare.operators.merge import merge_insert_absent, merge_partial
from wayfare.operators.migration import stamped
from wayfare.operators.ranking import top_active_zones
from wayfare.session import build_session, new_workdir, use_utc
from wayfare.sinks import jdbc
from wayfare.sinks.parquet import remove_partitions, write_by_date, write_partitioned, write_plain
from wayfare.sinks.report import preview, write_counted
from wayfare.sources.trips import enrich, read_trips, read_trips_merged
from wayfare.tables import TABLES


TOP = 10


def _hourly_top(trips: DataFrame, top: int = TOP) -> DataFrame:
    return top_active_zones(summaries.zone_window_stats(trips, "1 hour"), top)


SUMMARIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "daily_summary": summaries.daily_summary,
    "hourly_zone_stats": summaries.hourly_zone_stats,
    "route_analysis": summaries.route_analysis,
    "real_time_zones": summaries.zone_window_stats,
    "real_time_global": summaries.global_window_stats,
    "top_active_zones": _hourly_top,
}
# Tables stored below the date of this column.
WINDOW_TABLES = {
    "real_time_zones": "window_start",
    "real_time_global": "window_start",
    "top_active_zones": "update_time",
}
PARTITIONS = dict.fromkeys(WINDOW_TABLES, "window_date")  # of the others: date


def stored_rows(table: str, trips: DataFrame, top: int = TOP) -> DataFrame:
    """The rows that a stored table holds for these trips."""
    if table == "route_analysis":
        return summaries.route_parts(trips)
    if table == "top_active_zones":
        return _hourly_top(trips, top)
    return SUMMARIES[table](trips)


def read_stored(spark: SparkSession, table: str, path: str) -> DataFrame:
    """A stored table as it is meant to be read."""
    rows = spark.read.parquet(path)
    return summaries.routes_from_parts(rows) if table == "route_analysis" else rows


def store(table: str, rows: DataFrame, path: str) -> None:
    """Write what ``stored_rows`` gives, replacing the dates present in the rows."""
    if table in WINDOW_TABLES:
        day = F.to_date(WINDOW_TABLES[table])
        write_partitioned(rows, path, "window_date", day, "replace", (WINDOW_TABLES[table],))
    else:
        write_by_date(rows, path, "replace")


# Merges of a run with what is stored for its dates: of a key that is there already, nothing is replaced,
# or only what the run computes anew.
MERGES = ("insert-absent", "partial")


def _stored_dates(spark: SparkSession, table: str, rows: DataFrame, path: str) -> DataFrame | None:
    """The stored rows of the dates that ``rows`` has; only their folders are read."""
    try:
        stored = spark.read.schema(rows.schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return None
    column = PARTITIONS.get(table, "date")
    touched = rows.select(F.col(column).alias("_date")).distinct()
    return stored.join(touched, F.col(column).eqNullSafe(F.col("_date")), "left_semi")


def merged_with_stored(
    spark: SparkSession, table: str, rows: DataFrame, path: str, merge: str, replace: Sequence[str] = ()
) -> DataFrame:
    """The rows of a run merged with the stored rows of their dates, staged beside the table, so that it
    can be written from there. ``partial`` replaces the columns in ``replace`` of keys that exist."""
    keys = TABLES[table].keys
    if table in WINDOW_TABLES:
        rows = rows.withColumn("window_date", F.to_date(WINDOW_TABLES[table]))
    stored = _stored_dates(spark, table, rows, path)
    if stored is not None:
        if merge == "partial":
            unknown = set(replace) - set(rows.columns) | set(replace) & set(keys)
            if unknown or not replace:
                raise ValueError(f"columns to replace in {table}: some of its own, and no keys: {sorted(unknown)}")
            rows = merge_partial(stored, rows, keys, replace)
        else:
            rows = merge_insert_absent(stored, rows, keys)
    staged = new_workdir(spark, f"merge-{table}")
    rows.write.parquet(staged)
    return spark.read.schema(rows.schema).parquet(staged).drop("window_date")


def drop_old_dates(spark: SparkSession, table: str, path: str, today: dt.date, days: int) -> int:
    """Remove the folders of dates before ``today - days`` of a stored table; returns how many. Folder
    names say which; no file is opened."""
    column = PARTITIONS.get(table, "date")
    keep_from = today - dt.timedelta(days=days)
    dates = spark.read.parquet(path).select(F.col(column).cast("string").alias("d")).distinct()
    old = [r.d for r in dates.where(F.col("d") < str(keep_from)).orderBy("d").collect()]
    return remove_partitions(spark, path, column, old)


def load(
    spark: SparkSession,
    paths: Sequence[str],
    day: dt.date | str | None = None,
    merge_schemas: bool = False,
) -> DataFrame:
    reader = read_trips_merged if merge_schemas else read_trips
    return on_day(enrich(reader(spark, *paths)), day)


def run(
    spark: SparkSession,
    table: str,
    paths: Sequence[str],
    output: str | None = None,
    day: dt.date | str | None = None,
    target: jdbc.JdbcTarget | None = None,
    merge_schemas: bool = False,
    rejects: str | None = None,
    top: int = TOP,
    created_at: bool = False,
    merge: str | None = None,
    replace: Sequence[str] = (),
) -> int:
    """Compute one table, write it to Parquet or over JDBC, return the rows written.

    With ``rejects`` only valid trips count; the others are written there with the reason.
    ``created_at`` stamps the rows with the time of the run. ``merge`` keeps stored rows of the same
    dates (see ``MERGES``) instead of replacing them; it returns the rows of these dates.
    A run without trips writes nothing, and replaces nothing.

    Routes over JDBC have a key without a date, so only the whole history can be stored there: days of
    routes are not added up by a database that has finished means.
    """
    if target and table == "route_analysis" and day is not None:
        raise ValueError("route_analysis over JDBC has no date in its key: only the whole history can be stored")
    if merge and (target or table == "route_analysis"):
        raise ValueError("merges are for Parquet tables with a date; routes are parts that are replaced by date")
    trips = load(use_utc(spark), paths, day, merge_schemas)
    if rejects:
        trips, invalid = split_invalid(trips)
        write_plain(invalid, rejects, "overwrite")
    if target:
        rows = _hourly_top(trips, top) if table == "top_active_zones" else SUMMARIES[table](trips)
        rows = stamped(rows) if created_at else rows
        return write_counted(rows, lambda df: jdbc.append(df, table, target))
    rows = stored_rows(table, trips, top)
    rows = stamped(rows) if created_at else rows
    if merge:
        rows = merged_with_stored(spark, table, rows, output, merge, replace)
    return write_counted(rows, lambda df: store(table, df, output))


def parse_day(text: str | None, all_history: bool, today: dt.date) -> dt.date | None:
    """The wanted day: given, none for the whole history, or yesterday."""
    if all_history:
        return None
    return dt.date.fromisoformat(text) if text else today - dt.timedelta(days=1)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("table", choices=sorted(SUMMARIES))
    parser.add_argument("day", nargs="?", help="YYYY-MM-DD, default yesterday")
    parser.add_argument("--all-history", action="store_true")
    parser.add_argument("--input", nargs="+", required=True)
    parser.add_argument("--output")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-property", nargs="*", default=[], help="name=value")
    parser.add_argument("--merge-schemas", action="store_true")
    parser.add_argument("--filter-invalid", metavar="PATH", help="folder for trips that break a rule")
    parser.add_argument("--top", type=int, default=TOP, help="zones of an hour in top_active_zones")
    parser.add_argument("--created-at", action="store_true", help="stamp rows with the time of the run")
    parser.add_argument("--merge", choices=MERGES, help="keep what is stored for the same keys")
    parser.add_argument("--replace", nargs="*", default=[], help="columns that a partial merge replaces")
    parser.add_argument("--retain-days", type=int, help="then remove dates older than that from --output")
    args = parser.parse_args(argv)
    if args.jdbc_url and (args.merge or args.retain_days is not None):
        parser.error("--merge and --retain-days are for --output")
    if bool(args.output) == bool(args.jdbc_url):
        parser.error("give either --output or --jdbc-url")

    target = None
    if args.jdbc_url:
        properties = dict(p.split("=", 1) for p in args.jdbc_property)
        target = jdbc.JdbcTarget(args.jdbc_url, properties)
    day = parse_day(args.day, args.all_history, dt.date.today())
    spark = build_session(f"wayfare {args.table}")
    try:
        rows = run(
            spark,
            args.table,
            args.input,
            args.output,
            day,
            target,
            args.merge_schemas,
            args.filter_invalid,
            args.top,
            args.created_at,
            args.merge,
            args.replace,
        )
        print(f"{args.table}: {rows} rows written for {day or 'all history'}")
        if args.retain_days is not None and (rows or day is None):
            gone = drop_old_dates(spark, args.table, args.output, dt.date.today(), args.retain_days)
            print(f"{args.table}: {gone} old dates removed")
        if rows and args.output:
            preview(read_stored(spark, args.table, args.output))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
