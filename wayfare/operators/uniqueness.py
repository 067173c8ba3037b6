"""Unique keys at append, without reading the table.

Beside the data lies a Bloom filter for each partition, as a table of 64-bit words: an aggregate like
any other, made by ``bit_or``. New keys are looked up in it; only those it knows, by right or by chance,
are compared with stored rows, and only with those of their partitions. An append that brings nothing
old reads no data file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators.quality import duplicate_keys
from wayfare.sinks.parquet import write_partitioned

BITS = 1 << 24  # of a partition's filter: 2 MB at most
PROBES = 4  # bits of a key
ROWS, FILTERS = "rows", "filters"


def _probes(keys: Sequence[str], bits: int) -> Column:
    """The bits of a key, as (word, bit) pairs. Null is a key value like any other."""
    known = [F.col(f"`{k}`") for k in keys] + [F.col(f"`{k}`").isNull() for k in keys]
    places = [F.pmod(F.xxhash64(F.lit(k), *known), F.lit(bits)) for k in range(PROBES)]
    pairs = [F.struct(F.shiftright(p, 6).alias("word"), (p % 64).cast("int").alias("bit")) for p in places]
    return F.array(*pairs)


def bloom_words(rows: DataFrame, keys: Sequence[str], partition: str, bits: int = BITS) -> DataFrame:
    """(partition, word, map) of the keys of some rows: tasks combine their words before the shuffle."""
    probes = rows.select(F.col(partition), F.inline(_probes(keys, bits)))
    return probes.groupBy(partition, "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("map"))


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _old_filter(spark: SparkSession, path: str, partition: str, like: DataFrame) -> DataFrame | None:
    """The filter of all appends so far, merged."""
    words = _stored(spark, f"{path}/{FILTERS}")
    if words is None:
        return None
    kind = like.schema[partition].dataType
    return words.groupBy(F.col(partition).cast(kind).alias(partition), "word").agg(F.bit_or("map").alias("map"))


def maybe_stored(
    rows: DataFrame, path: str, keys: Sequence[str], partition: str, bits: int = BITS
) -> DataFrame | None:
    """Distinct keys of ``rows`` that the filter knows: all that are stored, and few others. None while
    nothing is stored. ``partition`` is one of the keys."""
    words = _old_filter(rows.sparkSession, path, partition, rows)
    if words is None:
        return None
    probes = rows.select(*keys).distinct().withColumn("_probes", _probes(keys, bits)).select("*", F.inline("_probes"))
    words = words.withColumnRenamed(partition, "_partition").withColumnRenamed("word", "_word")
    same = F.col(partition).eqNullSafe(F.col("_partition")) & (F.col("word") == F.col("_word"))
    hit = F.expr("(shiftright(map, bit) & 1L) = 1")
    hits = probes.join(words, same).where(hit).groupBy(*keys).agg(F.count(F.lit(1)).alias("_hits"))
    return hits.where(F.col("_hits") == PROBES).select(*keys)


def violations(rows: DataFrame, path: str, keys: Sequence[str], partition: str, bits: int = BITS) -> DataFrame:
    """(keys, rows): keys that would be there more than once after an append, with the number of rows.

    Nulls are equal to each other. Stored rows are read only for the partitions of keys that the filter
    knows; the partitions come to the driver, to prune folders.
    """
    repeated = duplicate_keys(rows, keys)
    known = maybe_stored(rows, path, keys, partition, bits)
    if known is None:
        return repeated
    # Few keys are known as a rule: they are found first, since no data file is read without any.
    known = known.persist()
    touched = [r[0] for r in known.select(partition).distinct().collect()]
    if not touched:
        known.unpersist()
        return repeated
    table = _stored(rows.sparkSession, f"{path}/{ROWS}")
    if table is None:  # an append that broke off after writing its filter
        return repeated
    kind = rows.schema[partition].dataType
    in_dates = F.col(partition).isin([F.lit(d).cast(kind) for d in touched if d is not None])
    if None in touched:
        in_dates = in_dates | F.col(partition).isNull()
    old = table.withColumn(partition, F.col(partition).cast(kind)).where(in_dates).select(*keys)
    same = F.expr(" AND ".join(f"o.`{k}` <=> n.`{k}`" for k in keys))
    twice = old.alias("o").join(known.alias("n"), same, "left_semi")
    counted = twice.withColumn("_new", F.lit(0)).unionByName(rows.select(*keys).withColumn("_new", F.lit(1)))
    totals = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.max("_new").alias("_new"))
    return totals.where("rows > 1 AND _new = 1").drop("_new")


def append_unique(rows: DataFrame, path: str, keys: Sequence[str], partition: str = "date", bits: int = BITS) -> None:
    """Append rows below ``path/rows`` if that leaves every key unique; otherwise nothing is stored and
    the violations are in the error, ten of them at most.

    The filter is written first: an append that breaks off between leaves a filter that knows too much,
    which costs a comparison and no row. Appends to one table go one after the other.
    """
    found = violations(rows, path, keys, partition, bits).limit(11).collect()
    if found:
        shown = ", ".join(str(tuple(r[k] for k in keys)) for r in found[:10])
        raise ValueError(f"keys {tuple(keys)} would not be unique: {shown}{' ...' if len(found) > 10 else ''}")
    bloom_words(rows, keys, partition, bits).hint("rebalance", partition).write.mode("append").partitionBy(
        partition
    ).parquet(f"{path}/{FILTERS}")
    write_partitioned(rows, f"{path}/{ROWS}", partition)
