"""Keyed upserts from a stream into Parquet.

Every micro-batch writes the rows it emitted below ``window_date=.../emission=<batch id>``.
Writing a batch again replaces its own folders and nothing else, so a restart neither loses
nor doubles rows, and the cost of a batch follows its size, not the table's. Readers take
the last emission of each key; :func:`publish` does so once per date and stores the result, and
:func:`compact_emissions` keeps the number of folders small until then.
Batch ids order the emissions: a stream that starts over with a new checkpoint needs a new
path.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from wayfare.operators.merge import merge_replace, one_per_key
from wayfare.session import new_workdir, stream_settings
from wayfare.sinks.parquet import remove_partitions

EMISSION = "emission"
WINDOW_DATE = "window_date"


def emission_writer(
    path: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    time: str = "window_start",
    rows_per_writer: int = 1_000_000,
    keys: Sequence[str] = (),
    compact_every: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores what a batch emitted.

    Adaptive execution is off inside a stateful stream, so the rows of each date are counted first and
    spread over as many tasks as they need, one file each; without that every state partition would
    write a file for every date, or one task a whole backfill. Every ``compact_every`` batches the
    emissions are folded together by their ``keys``.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        dated = rows.withColumns({WINDOW_DATE: F.to_date(time), EMISSION: F.lit(batch_id)}).persist()
        try:
            counts = dated.groupBy(WINDOW_DATE).count().where(F.col("count") > rows_per_writer).collect()
            writers = [F.lit(x) for r in counts for x in (r[WINDOW_DATE], -(-r["count"] // rows_per_writer))]
            writer = F.lit(0)
            if writers:
                most = F.coalesce(F.create_map(*writers)[F.col(WINDOW_DATE)], F.lit(1))
                writer = F.pmod(F.xxhash64(*rows.columns), most)
            (
                dated.repartition(F.col(WINDOW_DATE), writer)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(WINDOW_DATE, EMISSION)
                .parquet(path)
            )
        finally:
            dated.unpersist()
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_emissions(rows.sparkSession, path, rows.schema, keys)

    return save


def start_emissions(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    output_mode: str = "update",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    time: str = "window_start",
    interval: str | None = None,
    parallelism: int | None = None,
    rows_per_writer: int = 1_000_000,
    keys: Sequence[str] = (),
    compact_every: int | None = None,
) -> StreamingQuery:
    """Start storing emissions: every ``interval``, or once over everything available."""
    save = emission_writer(path, transform, time, rows_per_writer, keys, compact_every)
    writer: DataStreamWriter = (
        rows.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(save)
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    with stream_settings(rows.sparkSession, parallelism):
        return writer.trigger(**trigger).start()


def _folders(spark: SparkSession, path: str) -> dict[str, list[tuple[int, int]]]:
    """Emissions of each date, oldest first, with their bytes; no file is opened."""
    found = F.regexp_extract("path", rf"{WINDOW_DATE}=(\d{{4}}-\d\d-\d\d)/{EMISSION}=(\d+)/", 1)
    emission = F.regexp_extract("path", rf"{WINDOW_DATE}=\d{{4}}-\d\d-\d\d/{EMISSION}=(\d+)/", 1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    sizes = (
        files.select(found.alias("date"), emission.alias("emission"), "length")
        .where("emission <> ''")
        .groupBy("date", F.col("emission").cast("long").alias("emission"))
        .agg(F.sum("length").alias("bytes"))
    )
    folders: dict[str, list[tuple[int, int]]] = {}
    for r in sizes.orderBy("date", "emission").collect():
        folders.setdefault(r.date, []).append((r.emission, r.bytes))
    return folders


def runs_to_fold(sizes: Sequence[tuple[int, int]], fan_in: int, smallest: int = 1 << 20) -> list[list[int]]:
    """Neighbouring emissions to fold into one, from (emission, bytes), oldest first.

    ``fan_in`` neighbours of one size class (a power of ``fan_in``) are folded, and so on with what
    comes of it, so a row is written again as often as there are classes. Where classes alternate so
    that nothing folds, everything does once there are four times ``fan_in`` runs.
    """

    def size_class(size: int) -> int:
        level, top = 0, smallest
        while size > top:
            level, top = level + 1, top * fan_in
        return level

    runs: list[tuple[list[int], int]] = []
    for emission, size in sizes:
        runs.append(([emission], size))
        while len(runs) >= fan_in and len({size_class(s) for _, s in runs[-fan_in:]}) == 1 or len(runs) >= 4 * fan_in:
            tail = runs[-fan_in:] if len(runs) < 4 * fan_in else runs[:]
            runs[-len(tail) :] = [([e for own, _ in tail for e in own], max(sum(s for _, s in tail), smallest + 1))]
    return [own for own, _ in runs if len(own) > 1]


def compact_emissions(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], fan_in: int = 8
) -> int:
    """Fold neighbouring emissions of a date together; returns how many folders are gone.

    The last row of each key is added to the youngest folder of its run, unless that has the key
    already, and the older folders are removed after that. Nothing is replaced: whoever reads in
    between, or after a run that broke off, finds rows twice, with the same last emission of every key.
    The newest emission is left alone, since Spark may write it again. All dates are one job.
    """
    folders = _folders(spark, path)
    newest = max((own[-1][0] for own in folders.values()), default=-1)
    folds = {
        date: runs_to_fold([f for f in own if f[0] < newest], fan_in) for date, own in folders.items()
    }
    into = [(date, e, run[-1]) for date, runs in folds.items() for run in runs for e in run]
    if not into:
        return 0
    targets = spark.createDataFrame(into, f"date string, {EMISSION} long, target long")
    targets = targets.withColumn(WINDOW_DATE, F.col("date").cast("date")).drop("date")
    rows = read_emissions(spark, path, schema).where(F.col(EMISSION) < newest)
    last = one_per_key(rows.join(targets, [WINDOW_DATE, EMISSION]), [WINDOW_DATE, "target", *keys], EMISSION)
    (
        last.where(F.col(EMISSION) < F.col("target"))
        .select(*schema.names, WINDOW_DATE, F.col("target").alias(EMISSION))
        .hint("rebalance", WINDOW_DATE, EMISSION)
        .write.mode("append")
        .partitionBy(WINDOW_DATE, EMISSION)
        .parquet(path)
    )
    gone = 0
    for date, runs in folds.items():
        old = [str(e) for run in runs for e in run[:-1]]
        gone += remove_partitions(spark, f"{path}/{WINDOW_DATE}={date}", EMISSION, old)
    return gone


def read_emissions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All stored emissions of rows with this schema."""
    stored = T.StructType(
        [
            *schema.fields,
            T.StructField(WINDOW_DATE, T.DateType()),
            T.StructField(EMISSION, T.LongType()),
        ]
    )
    return spark.read.schema(stored).parquet(path)


def current_rows(emissions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last emission of every key. Filters on ``window_date`` prune folders."""
    latest = one_per_key(emissions, [WINDOW_DATE, *keys], EMISSION)
    return latest.drop(EMISSION)


def _stored_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return None


def publish(
    emissions: DataFrame, table_path: str, keys: Sequence[str], dates: Iterable[str] | None = None
) -> None:
    """Merge the current rows of some dates (all by default, none if empty) into a table.

    Rows that the table holds already stay, unless the emissions have the same key: the
    emissions of another path, or of folders removed since, are not lost. The dates concerned
    are written beside the table first and replaced from there, so a run that fails is simply
    run again. Once a date is closed and published, its emission folders may be removed.
    """
    if dates is not None:
        wanted = [F.lit(d).cast("date") for d in dates]
        if not wanted:
            return
        emissions = emissions.filter(F.col(WINDOW_DATE).isin(wanted))
    spark = emissions.sparkSession
    rows = current_rows(emissions, keys)
    stored = _stored_table(spark, table_path, rows.schema)
    if stored is not None:
        touched = emissions.select(F.col(WINDOW_DATE).alias("_date")).distinct()
        same_date = stored.join(touched, F.col(WINDOW_DATE).eqNullSafe(F.col("_date")), "left_semi")
        rows = merge_replace(same_date, rows, [WINDOW_DATE, *keys])
    staged = new_workdir(spark, "publish")
    for frame, path in ((rows, staged), (None, table_path)):
        frame = spark.read.schema(rows.schema).parquet(staged) if frame is None else frame
        (
            frame.hint("rebalance", WINDOW_DATE)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(WINDOW_DATE)
            .parquet(path)
        )


def remove_emissions(spark: SparkSession, path: str, dates: Iterable[str]) -> int:
    """Remove the emissions of closed dates once they are published; listings stay short."""
    return remove_partitions(spark, path, WINDOW_DATE, dates)


def published_and_open(
    table: DataFrame, emissions: DataFrame, keys: Sequence[str], open_from: str
) -> DataFrame:
    """One table of closed dates, as published, and of the dates from ``open_from`` on, whose
    emissions are resolved while reading. Each side reads only its own folders."""
    border = F.lit(open_from).cast("date")
    closed = table.filter(F.col(WINDOW_DATE) < border)
    return closed.unionByName(current_rows(emissions.filter(F.col(WINDOW_DATE) >= border), keys))
