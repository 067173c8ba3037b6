"""What the footers of Parquet files say, read once by tasks.

The file list is a table; each task reads the ends of its files, not their rows. What comes back is a
row for each file, and files of one type are grouped in one aggregate, however many there are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOOTERS = "file_path string, bytes long, row_count long, column_bytes long, signature string"


def _local_uri(path: str) -> str:
    """Hadoop writes ``file:/x`` where other libraries want ``file:///x``."""
    scheme, colon, rest = path.partition(":")
    return f"{scheme}://{rest}" if colon and rest.startswith("/") and not rest.startswith("//") else path


def _footer(path: str) -> tuple[int | None, int | None, str | None]:
    """Rows, compressed bytes of the columns, and names and types of a file; nulls where this machine
    cannot open the store or the file has no footer."""
    import pyarrow.parquet as pq
    from pyarrow.fs import FileSystem

    try:
        filesystem, name = FileSystem.from_uri(_local_uri(path))
        metadata = pq.read_metadata(name, filesystem=filesystem)
    except (OSError, ValueError, NotImplementedError):
        return None, None, None
    schema = metadata.schema
    columns = sorted(
        (c.path, c.physical_type, str(c.logical_type), c.max_repetition_level) for c in map(schema.column, range(len(schema)))
    )
    size = sum(
        metadata.row_group(g).column(c).total_compressed_size
        for g in range(metadata.num_row_groups)
        for c in range(metadata.num_columns)
    )
    return metadata.num_rows, size, json.dumps(columns)


def footers(spark: SparkSession, *paths: str) -> DataFrame:
    """(file_path, bytes, row_count, column_bytes, signature) of all Parquet files in some folders.

    The signature tells names and types of the columns, whatever their order; files with the same one
    can be read by one scan. Where executors cannot open the store by themselves (only Spark's readers
    know it), what the footer says is null, and size and path are still there.
    """
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            found = [_footer(path) for path in paths]
            rows, sizes, signatures = zip(*found) if found else ((), (), ())
            arrays = [pa.array(paths, pa.string()), batch.column(1), pa.array(rows, pa.int64())]
            arrays += [pa.array(sizes, pa.int64()), pa.array(signatures, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["file_path", "bytes", "row_count", "column_bytes", "signature"])

    return files.mapInArrow(run, FOOTERS)


def by_signature(spark: SparkSession, path: str) -> list[tuple[str | None, list[str]]]:
    """The files of a folder, grouped by signature, in the order of their names: one aggregate. The
    driver gets the file names, as it does for any scan."""
    found = footers(spark, path).groupBy("signature").agg(F.array_sort(F.collect_list("file_path")).alias("files"))
    return sorted(((r.signature, r.files) for r in found.collect()), key=lambda g: g[1])


def profile(catalogue: DataFrame) -> DataFrame:
    """Files, bytes, rows and different types of a catalogue: what a listing of a data set shows, and no
    row is read for it."""
    return catalogue.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.max("bytes"), F.lit(0)).alias("largest_bytes"),
        F.sum("row_count").alias("row_count"),
        F.count_distinct("signature").alias("signatures"),
    )
