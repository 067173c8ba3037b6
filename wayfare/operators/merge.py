"""Keyed merges of a batch into a table, as DataFrame -> DataFrame functions.

Keys match null-safely, so merging a batch a second time changes nothing even where a key
is null. A key repeated inside the batch ends as one row, as if its rows had come one by one.
Every merge is one join that reads each side once. Joins carry no hints: Spark broadcasts the
batch only when its size allows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same_keys(keys: Sequence[str]) -> Column:
    """Key equality of the sides aliased ``t`` and ``b``; names keep self-joins unambiguous."""
    return F.expr(" AND ".join(f"t.`{k}` <=> b.`{k}`" for k in keys))


def one_per_key(
    batch: DataFrame, keys: Sequence[str], sequence: str | None = None, last: bool = True
) -> DataFrame:
    """One row per key: the one with the highest (or lowest) sequence.

    An aggregate over the row as a struct, combined before the shuffle: a key repeated many
    times costs one row per task. Equal sequence numbers, or rows without a sequence, are
    settled by the other columns.
    """
    first = [sequence] if sequence else []
    others = [c for c in batch.columns if c not in keys and c != sequence]
    if not first and not others:
        return batch.distinct()
    row = F.struct(*first, *others)
    pick = F.max(row) if last else F.min(row)
    chosen = batch.groupBy(*keys).agg(pick.alias("_row"))
    return chosen.select(*keys, "_row.*").select(*batch.columns)


def _merged(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    replace: Sequence[str],
    sequence: str | None,
    last: bool,
) -> DataFrame:
    single = one_per_key(batch, keys, sequence, last)
    old = target.withColumn("_in_target", F.lit(True)).alias("t")
    new = single.withColumn("_in_batch", F.lit(True)).alias("b")
    columns = []
    for c in target.columns:
        from_batch = "_in_batch" if c in replace else "_in_target IS NULL"
        columns.append(f"CASE WHEN {from_batch} THEN b.`{c}` ELSE t.`{c}` END AS `{c}`")
    return old.join(new, _same_keys(keys), "full_outer").selectExpr(*columns)


def merge_insert_absent(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], sequence: str | None = None
) -> DataFrame:
    """Add the batch rows whose key the target does not have; of a repeated key the first row."""
    return _merged(target, batch, keys, (), sequence, last=False)


def merge_partial(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    replace: Sequence[str],
    sequence: str | None = None,
) -> DataFrame:
    """Replace only the listed columns of rows present on both sides; add new rows whole.

    Of a repeated key the last row counts.
    """
    return _merged(target, batch, keys, replace, sequence, last=True)


def merge_replace(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str] = (),
    sequence: str | None = None,
) -> DataFrame:
    """Batch rows take the place of target rows with the same key; of a repeated key the last.

    Columns in ``keep`` stay as they are on rows that exist already.
    """
    replace = [c for c in target.columns if c not in keep]
    return _merged(target, batch, keys, replace, sequence, last=True)
