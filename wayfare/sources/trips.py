"""Reading historical trips from Parquet into one canonical shape."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.times import duration_minutes
from wayfare.sources.footers import by_signature
from wayfare.tables import LANDING_DATE, TRIP_SCHEMA

# File type -> wanted type pairs the Parquet reader converts by itself. Any other
# difference is read as stored and cast per column, so the scan never fails half way.
_READ_DIRECTLY = {
    (T.TimestampType(), T.TimestampNTZType()),
    (T.IntegerType(), T.LongType()),
    (T.ShortType(), T.LongType()),
    (T.ByteType(), T.LongType()),
    (T.FloatType(), T.DoubleType()),
}


def _scan_type(stored: T.DataType, wanted: T.DataType) -> T.DataType:
    return wanted if stored == wanted or (stored, wanted) in _READ_DIRECTLY else stored


def _conform(
    found: DataFrame, reader: DataFrameReader, wanted: T.StructType, paths: Sequence[str]
) -> DataFrame:
    """The wanted columns in the wanted types, plus the landing partition if there is one.

    Files that already agree are used as found; otherwise they are read once more with a
    schema that lets the scan convert what it can, and the rest is cast.
    """
    stored = {f.name: f.dataType for f in found.schema.fields}
    names = wanted.names + [c for c in (LANDING_DATE,) if c in stored and c not in wanted.names]
    if all(stored.get(f.name) == f.dataType for f in wanted.fields):
        return found.select(*names)
    scan_types = {f.name: _scan_type(stored.get(f.name, f.dataType), f.dataType) for f in wanted.fields}
    scan = reader.schema(T.StructType([T.StructField(c, t) for c, t in scan_types.items()])).parquet(*paths)
    casts = {
        f.name: F.col(f.name).try_cast(f.dataType)
        for f in wanted.fields
        if scan_types[f.name] != f.dataType
    }
    return scan.withColumns(casts).select(*names)


def _same_types(spark: SparkSession, base: str, files: list[str]) -> list[tuple[list[str], DataFrame]]:
    """Files in groups whose column types agree, where no footer can be read by the tasks.

    Spark compares the footers in a job of its own. Where they conflict the files, in the
    order of their names, are halved: types change from one delivery to the next, so a
    folder with few changes takes few jobs.
    """
    reader = spark.read.option("mergeSchema", "true").option("basePath", base)
    try:
        return [(files, reader.parquet(*files))]
    except (PySparkException, Py4JJavaError) as error:
        if len(files) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    half = len(files) // 2
    groups: dict[str, list[str]] = {}
    for part in (files[:half], files[half:]):
        for own, found in _same_types(spark, base, part):
            types = {f.name: f.dataType for f in found.schema.fields}
            groups.setdefault(repr(sorted(types.items(), key=lambda t: t[0])), []).extend(own)
    return [(own, reader.parquet(*own)) for own in groups.values()]


def _groups(spark: SparkSession, path: str) -> list[tuple[list[str], DataFrame]]:
    """Files in groups whose types agree, each with a frame of all its columns.

    The tasks read all footers once; after that every group is one listing and one footer, so the
    number of jobs goes with the number of different types, not with the files.
    """
    found = by_signature(spark, path)
    if len(found) == 1 and found[0][0] is not None:
        return [([path], spark.read.parquet(path))]
    reader = spark.read.option("basePath", path)
    groups = []
    for signature, files in found:
        groups += [(files, reader.parquet(*files))] if signature else _same_types(spark, path, files)
    if not groups:  # no file: let Spark say so
        return [([path], spark.read.parquet(path))]
    return [([path], groups[0][1])] if len(groups) == 1 else groups


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _reader(spark: SparkSession, path: str, files: list[str]) -> DataFrameReader:
    return spark.read if files == [path] else spark.read.option("basePath", path)


def read_trips(spark: SparkSession, *paths: str) -> DataFrame:
    """The ten trip columns of one or more Parquet folders.

    Files are adapted by their own types, also within a folder: a column stored with another
    type is cast, values that do not convert become null, a missing column is null. Only
    these columns are scanned.
    """
    return _union(
        [
            _conform(found, _reader(spark, path, files), TRIP_SCHEMA, files)
            for path in paths
            for files, found in _groups(spark, path)
        ]
    )


def read_trips_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """All columns found in any file, with the trip columns in their wanted types.

    A further column that is stored with several types is read as text.
    """
    groups = [(path, *group) for path in paths for group in _groups(spark, path)]
    wanted = {f.name: f for f in TRIP_SCHEMA.fields}
    fields: dict[str, T.StructField] = {}
    for _, _, found in groups:
        for f in found.schema.fields:
            known = fields.setdefault(f.name, wanted.get(f.name, f))
            if f.name not in wanted and known.dataType != f.dataType:
                fields[f.name] = T.StructField(f.name, T.StringType())
    return _union(
        [
            _conform(
                found,
                _reader(spark, path, files),
                T.StructType([fields[c] for c in found.columns]),
                files,
            )
            for path, files, found in groups
        ]
    )


def enrich(trips: DataFrame) -> DataFrame:
    """Zone ids as text under their own names, and the duration unless it is given."""
    names = {"PULocationID": "pickup_zone", "DOLocationID": "dropoff_zone"}
    columns = []
    for c in trips.columns:
        zone = names.get(c, c)
        if zone in names.values() and (c == zone or zone not in trips.columns):
            columns.append(f"CAST({c} AS STRING) AS {zone}")
        else:
            columns.append(f"`{c}`")
    if "duration_minutes" not in trips.columns:
        minutes = duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime")
        columns.append(f"{minutes} AS duration_minutes")
    return trips.selectExpr(*columns)


def has_rows(df: DataFrame) -> bool:
    """Whether there is any row; stops at the first one instead of counting."""
    return not df.isEmpty()
