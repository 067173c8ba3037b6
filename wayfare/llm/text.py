"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.session import new_workdir

# A word is a run of code points other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_list(text: str | Column) -> Column:
    """Words of a text as an array; null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; ``bytes.split`` cuts at exactly the ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table below the shared folder and read it back.

    This cuts the lineage: a lost executor costs a reread, not the work before it. The size of
    what comes back is known to Spark, which then broadcasts only tables below its limit.
    """
    spark = df.sparkSession
    path = new_workdir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(
    df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[dict] | dict], schema: str
) -> DataFrame:
    """Apply a function from record batch to columns, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(work(batch))

    return df.mapInArrow(run, schema)
