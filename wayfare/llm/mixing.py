"""Mix sources to target weights by hash thresholds.

A document has a fixed pseudo-random place between 0 and 2^60. A source whose target is ``q``
whole passes and a remainder takes every document ``q`` times, and those below a threshold once
more. The threshold is found from histograms of words by source and hash bucket: the bucket in
which the running sum passes the remainder is split into finer buckets, and only that one. The
documents themselves are never sorted, and never leave the task that reads them except as
partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.text import WORD, stored

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
HASH_BITS = 60
LEVEL_BITS = 12  # a histogram has at most 2^12 buckets for each source


def n_words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(*columns: str | Column) -> Column:
    """A value below 2^60 that depends on the row alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("mix"), *columns), 64 - HASH_BITS)


def targets(
    totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, most: int = MAX_REPEATS
) -> DataFrame:
    """Target of each source from a table (source, source_size) with one row for each source.

    Sources in order of their code points, null last, take the weights in turn. A share of all
    words is dealt by weight; no source gets more than ``most`` times its size, and what is cut
    off goes to the others by weight, until none is above. That rest point is a water level: a
    source gets ``min(weight * level, most * size)``. In the order of ``most * size / weight``
    the capped sources come first, so two running sums give the level.
    """
    # UTF-8 bytes are ordered as code points, whatever the collation of the session.
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1,
    )
    rest = Window.orderBy("full_at", F.col("source").isNull(), F.encode("source", "UTF-8"))
    so_far = rest.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(F.lit(1))
    dealt = (
        totals.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("full_at", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(whole) * F.lit(float(share)))
        .withColumn("capped", F.sum("cap").over(so_far))
        .withColumn("open_weight", F.sum("weight").over(whole) - F.sum("weight").over(so_far))
        # Words given out when the level has just filled this source.
        .withColumn("given", F.col("capped") + F.col("open_weight") * F.col("full_at"))
        .withColumn("is_full", F.col("given") <= F.col("budget"))
    )
    full = F.col("is_full")
    level = (
        F.col("budget") - F.coalesce(F.sum(F.when(full, F.col("cap"))).over(whole), F.lit(0.0))
    ) / F.sum(F.when(~full, F.col("weight"))).over(whole)
    return dealt.withColumn("level", level).select(
        "source",
        "source_size",
        F.when(full, F.col("cap"))
        .otherwise(F.least(F.col("weight") * F.col("level"), F.col("cap")))
        .cast("double")
        .alias("target"),
    )


def _boundary(sized: DataFrame, start: DataFrame, rule: Column) -> DataFrame:
    """(s, at, before, words): the place at which the words pass what is left, for each source.

    ``start`` has (s, left, ...), ``rule`` says which documents of ``sized`` count. ``before`` is
    what is still left in front of the place, ``words`` what lies on it. Sources whose documents
    do not reach what is left are missing.
    """
    mine = F.col("source").eqNullSafe(F.col("s"))
    found = start.select("*", F.col("left").alias("before"), F.lit(0).cast("long").alias("at"))
    for bits in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        # The first level reads every document, the others the boundary bucket of each source.
        within = F.shiftright("place", bits + LEVEL_BITS) == F.shiftright("at", bits + LEVEL_BITS)
        histogram = (
            sized.join(found, mine & rule & within)
            .groupBy(*start.columns, "before", F.shiftright("place", bits).alias("bucket"))
            .agg(F.sum("size").alias("words"))
        )
        running = F.sum("words").over(
            Window.partitionBy("s")
            .orderBy("bucket")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        boundary = (
            histogram.withColumn("upto", running)
            .where(F.col("upto") > F.col("before"))
            .groupBy(*start.columns, "before")
            .agg(F.min_by(F.struct("bucket", "words", "upto"), "bucket").alias("b"))
        )
        found = stored(
            boundary.select(
                *start.columns,
                (F.col("before") - F.col("b.upto") + F.col("b.words")).alias("before"),
                F.shiftleft("b.bucket", bits).alias("at"),
                F.col("b.words").alias("words"),
            ),
            "mix-boundary",
        )
    return found.select("s", "at", "before", "words")


def _limits(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, ..., passes, below, fits, after, below_2): which documents count once more.

    Those with a place under ``below``, and those of at most ``fits`` words with a place over
    ``after`` and under ``below_2``.
    """
    passes = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    goals = goals.withColumn("passes", passes.cast("long"))
    start = goals.where("target > 0").select(
        F.col("source").alias("s"),
        (F.col("target") - F.col("passes") * F.col("source_size")).alias("left"),
    )
    first = _boundary(sized, start, F.lit(True))
    rest = first.select("s", F.col("before").alias("left"), F.col("at").alias("after"))
    small = (F.col("place") > F.col("after")) & (F.col("size") <= F.col("left"))
    second = _boundary(sized, rest, small).toDF("s", "at_2", "before_2", "words_2")
    room = (
        sized.join(rest, F.col("source").eqNullSafe(F.col("s")) & small)
        .groupBy("s")
        .agg(F.sum("size").alias("room"))
    )
    near = F.least(F.col("before_2"), F.col("words_2") - F.col("before_2"))
    missed = F.coalesce(near, F.col("before") - F.coalesce("room", F.lit(0)))
    whole = F.col("words") - F.col("before") <= missed  # better with the boundary itself
    both = (
        first.join(second.withColumnRenamed("s", "s2"), F.col("s").eqNullSafe(F.col("s2")), "left")
        .join(room.withColumnRenamed("s", "s3"), F.col("s").eqNullSafe(F.col("s3")), "left")
        .select(
            "s",
            (F.col("at") + whole.cast("long")).alias("below"),
            F.col("before").alias("fits"),
            F.col("at").alias("after"),
            F.when(whole, F.lit(0))
            .when(F.col("at_2").isNull(), F.lit(1 << HASH_BITS))
            .otherwise(F.col("at_2") + (F.col("before_2") * 2 >= F.col("words_2")).cast("long"))
            .alias("below_2"),
        )
    )
    joined = goals.join(both, F.col("source").eqNullSafe(F.col("s")), "left")
    none = F.lit(0).cast("long")
    return joined.select(
        F.col("source").alias("s"),
        "source_size",
        "target",
        "passes",
        *[F.coalesce(c, none).alias(c) for c in ("below", "fits", "after", "below_2")],
    )


def plan_mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.0,
    most: int = MAX_REPEATS,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
) -> tuple[DataFrame, DataFrame]:
    """Sizes (key, source, size, place) of all rows, and limits with one row for each source."""
    sized = stored(
        docs.select(
            F.col(key).alias(key),
            F.col(source).alias("source"),
            n_words(F.col(text)).alias("size"),
            place(F.col(key), F.col(text)).alias("place"),
        ),
        "mix-sizes",
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stored(targets(totals, weights, share, most), "mix-targets")
    return sized, stored(_limits(sized, goals), "mix-limits")


def _times() -> Column:
    more = (F.col("place") < F.col("below")) | (
        (F.col("place") > F.col("after"))
        & (F.col("place") < F.col("below_2"))
        & (F.col("size") <= F.col("fits"))
    )
    return F.col("passes") + more.cast("long")


def mix(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """How many words the mix takes of each document: (key, size, source_size, target, taken).

    A document is taken a whole number of times, ``most`` at the utmost. Null text has size 0 and
    null source is a source of its own. Rows that agree in key and text are one unit, taken or
    left together; of documents without words nothing is taken. An empty table gives an empty
    result. Only the columns named in ``plan_mix`` are read, others are ignored. The rows of
    ``targets``, one for each source, are ordered in one task; the documents are not. The place
    depends on the row alone, so reruns agree.
    """
    sized, limits = plan_mix(docs, key=key, **options)
    return sized.join(limits, F.col("source").eqNullSafe(F.col("s")), "left").select(
        key, "size", "source_size", "target", (F.col("size") * _times()).alias("taken")
    )


def mixed_rows(
    docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **options
) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    _, limits = plan_mix(docs, text=text, source=source, key=key, **options)
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(source).alias("source"),
        n_words(F.col(text)).alias("size"),
        place(F.col(key), F.col(text)).alias("place"),
    )
    return (
        whole.join(limits, F.col("source").eqNullSafe(F.col("s")))
        .select("row", F.explode(F.array_repeat(F.lit(1), _times().cast("int"))))
        .select("row.*")
    )
