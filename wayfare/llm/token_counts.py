"""Token counts without token ids.

White space ends every pre-token of the tokenizer, so a text has as many tokens as the runs between
its white space have together. Every distinct run is tokenized once for the whole corpus; the
documents only count their runs, and the two tables are joined. The most frequent runs go to every
task as a table of fixed size, so that a run in every document meets nobody in the shuffle.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.text import stored, words_of

FREQUENT = 200_000  # rows at most of the table every task gets
MAX_FREQUENT_BYTES = 64  # longer runs are never in it: it stays below 15 MB
HELD = 200_000  # distinct runs a task holds before it hands them on
BATCH = 20_000
ROWS = 1_000
TAIL = b".,!"  # marks that are a pre-token of their own behind letters


def parts_of(run: bytes) -> tuple[bytes, bytes]:
    """A run of ASCII letters, in lower case, and the mark behind it: fewer distinct runs.

    Both are pre-tokens of their own, since letters end where a mark begins, and the tokenizer
    ignores the case of letters. Other runs stay as they are.
    """
    if run.isalpha():
        return run.lower(), b""
    if run[-1] in TAIL and run[:-1].isalpha():
        return run[:-1].lower(), run[-1:]
    return run, b""


def runs_of(text: str | None) -> Counter:
    counts: Counter = Counter()
    for run, n in Counter(words_of(text)).items():
        body, mark = parts_of(run)
        counts[body] += n
        if mark:
            counts[mark] += n
    return counts


@functools.cache
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def distinct_runs(docs: DataFrame, text: str) -> DataFrame:
    """(run, n) for all runs of the corpus; every task counts its own before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def hand_on() -> pa.RecordBatch:
            columns = [pa.array(list(held), pa.binary()), pa.array(held.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["run", "n"])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.update(runs_of(t))
                if len(held) > HELD:
                    yield hand_on()
                    held.clear()
        if held:
            yield hand_on()

    counted = docs.select(F.col(text)).mapInArrow(run, "run binary, n long")
    return counted.groupBy("run").agg(F.sum("n").alias("n"))


def with_pieces(runs: DataFrame, path: str) -> DataFrame:
    """Adds ``pieces``: how many tokens the run has. The only place that runs the tokenizer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                texts = [r.decode() for r in batch.column(0).to_pylist()]
                found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
                pieces = pa.array([len(x) for x in found], pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns, pieces], ["run", "n", "pieces"])

    return runs.mapInArrow(run, "run binary, n long, pieces long")


def frequent(runs: DataFrame, rows: int = FREQUENT) -> DataFrame:
    """The most frequent runs, ``rows`` at most: those above a frequency found from a histogram.

    The histogram has eight bins to a doubling, so a few hundred rows come to the driver.
    """
    short = runs.where(F.octet_length("run") <= MAX_FREQUENT_BYTES)
    step = F.floor(F.log2(F.col("n").cast("double")) * 8)
    bins = short.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    lowest, total = None, 0
    for b in bins:
        total += b["count"]
        if total > rows:
            break
        lowest = b["step"]
    return short.where(step >= F.lit(lowest)) if lowest is not None else short.where("false")


def count_tokens(
    docs: DataFrame, path: str, text: str = "text", columns: list[str] | None = None
) -> DataFrame:
    """``row`` with the given columns (all by default), ``n_bytes`` and ``n_tokens`` of its text.

    ``path`` is a tokenizer file of the ``tokenizers`` library that every executor can open, that
    ignores the case of letters and whose pre-tokens neither hold white space nor mix ASCII letters
    with other characters. Strings of
    special tokens count as the library takes them by default: as one token. Null and empty
    texts have none. Repeated rows stay repeated; an empty table gives an empty result; other
    columns pass through in ``row``.
    """
    runs = stored(with_pieces(distinct_runs(docs, text), path), "runs")
    common = frequent(runs).select("run", "pieces").collect()
    table = docs.sparkSession.sparkContext.broadcast({bytes(r): int(k) for r, k in common})
    # The numbers of the rows are written with them, so a task that is run again finds the same.
    counted = stored(_per_document(docs, table, text, columns or docs.columns), "run-counts")
    rare = (
        counted.select("at", F.inline("others"))
        .join(runs.select("run", "pieces"), "run")
        .groupBy("at")
        .agg(F.sum(F.col("pieces") * F.col("k")).alias("rare"))
    )
    total = F.col("known") + F.coalesce("rare", F.lit(0))
    return counted.join(rare, "at", "left").select("row", "n_bytes", total.alias("n_tokens"))


def _per_document(docs: DataFrame, table, text: str, columns: list[str]) -> DataFrame:
    """(at, row, n_bytes, known, others): tokens of frequent runs, and how often others occur."""
    numbered = docs.select(
        F.monotonically_increasing_id().alias("at"),
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    pair = T.StructType().add("run", T.BinaryType()).add("k", T.IntegerType())
    schema = numbered.select("at", "row", "n_bytes").schema
    schema = schema.add("known", "long").add("others", T.ArrayType(pair))
    names = ["at", "row", "n_bytes", "known", "others"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = table.value
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                known: list[int] = []
                runs: list[bytes] = []
                times: list[int] = []
                ends = [0]
                for t in batch.column(3).to_pylist():
                    tokens = 0
                    for r, n in runs_of(t).items():
                        pieces = frequent.get(r)
                        if pieces is None:
                            runs.append(r)
                            times.append(n)
                        else:
                            tokens += pieces * n
                    known.append(tokens)
                    ends.append(len(runs))
                pairs = pa.StructArray.from_arrays(
                    [pa.array(runs, pa.binary()), pa.array(times, pa.int32())], ["run", "k"]
                )
                others = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
                columns = [*batch.columns[:3], pa.array(known, pa.int64()), others]
                yield pa.RecordBatch.from_arrays(columns, names)

    return numbered.mapInArrow(run, schema)
