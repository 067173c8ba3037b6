"""Near-duplicate vectors by a subspace pigeonhole join.

Vectors of length one with a cosine of ``c`` have a squared distance of ``2 - 2c``. After a random
rotation they are cut into blocks; the squared distances of the blocks add up to that of the whole,
so in one block at least it is no more than the block's share of the budget. Each block is a
range join: by cells of a grid over some of its dimensions, a vector being sought in every cell that
its ball touches, and then by the distance in the block. What any block finds is compared
exactly, in double precision; a pair that several blocks find counts in the first.

No pair leaves its task: a task gives, for each vector, how many others it linked and with which
vector of its tile it hangs together.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.components import connected
from wayfare.llm.text import stored

BLOCK = 8  # dimensions of a block
TILE = 2048  # vectors on each side of a tile
CELL = 4096  # vectors a cell should hold; a label with more is cut along more dimensions
WIDTH = 4.0  # width of a cell, in radii of the ball that is sought
SLACK = 1e-6  # added to squared distances, far above rounding
CHUNK = 1 << 16  # pairs compared at once


@lru_cache(maxsize=8)
def rotation(dims: int) -> np.ndarray:
    """An orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def blocks_of(dims: int) -> list[tuple[int, int]]:
    count = max(1, dims // BLOCK)
    borders = [dims * k // count for k in range(count + 1)]
    return list(zip(borders, borders[1:]))


def unit_vectors(vectors: list) -> np.ndarray:
    """Rows of length one, in double precision."""
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _valid(vector: str) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(
        F.col(vector).isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )


def _placed(vectors: DataFrame, cuts: DataFrame, budget: float, key: str) -> DataFrame:
    """Rows (label, dims, block, cell, probe, key, vector): where each vector lies and is sought."""
    schema = (
        vectors.select("label", "dims").schema
        .add("block", T.IntegerType()).add("cell", T.StringType()).add("probe", T.BooleanType())
    )
    for field in vectors.select(key, "vector").schema:
        schema = schema.add(field)

    def run(frames):
        for frame in frames:
            for (dims, grid), rows in frame.groupby(["dims", "grid"], sort=True):
                turned = unit_vectors(rows["vector"].tolist()) @ rotation(dims)
                spans = blocks_of(dims)
                radius = math.sqrt(budget / len(spans) + SLACK)
                width = WIDTH * radius
                for block, (start, stop) in enumerate(spans):
                    x = turned[:, start : min(stop, start + grid)]
                    home = np.floor(x / width).astype(np.int64)
                    low = np.floor((x - radius) / width).astype(np.int64)
                    high = np.floor((x + radius) / width).astype(np.int64)
                    yield _rows(rows, key, block, home, np.arange(len(rows)), False)
                    at = np.arange(len(rows))
                    cells = np.zeros((len(rows), 0), np.int64)
                    for d in range(x.shape[1]):  # the ball reaches over at most one border
                        over = np.flatnonzero(high[at, d] > low[at, d])
                        cells = np.concatenate(
                            [
                                np.column_stack([cells, low[at, d]]),
                                np.column_stack([cells[over], high[at[over], d]]),
                            ]
                        )
                        at = np.concatenate([at, at[over]])
                    yield _rows(rows, key, block, cells, at, True)

    placed = vectors.join(cuts, ["label", "dims"])
    return placed.mapInPandas(run, schema)


def _rows(rows: pd.DataFrame, key: str, block: int, cells: np.ndarray, at: np.ndarray, probe: bool):
    out = rows.iloc[at][["label", "dims"]].copy()
    out["block"] = block
    out["cell"] = [",".join(map(str, c)) for c in cells.tolist()]
    out["probe"] = probe
    out[key] = rows[key].to_numpy()[at]
    out["vector"] = rows["vector"].to_numpy()[at]
    return out


def linked_pairs(x: np.ndarray, y: np.ndarray, block: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs that this block finds first and whose cosine is large enough.

    ``x`` and ``y`` are of length one and not rotated; the cosine is taken from them.
    """
    dims = x.shape[1]
    spans = blocks_of(dims)
    budget = (2 - 2 * cosine) / len(spans) + SLACK
    turn = rotation(dims)
    p, q = x @ turn, y @ turn
    start, stop = spans[block]
    a, b = p[:, start:stop], q[:, start:stop]
    near = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T) <= budget + SLACK
    i, j = np.nonzero(near)
    kept = []
    for k in range(0, len(i), CHUNK):
        u, v = i[k : k + CHUNK], j[k : k + CHUNK]
        good = (x[u] * y[v]).sum(1) >= cosine
        u, v = u[good], v[good]
        squares = np.add.reduceat((p[u] - q[v]) ** 2, [s for s, _ in spans], axis=1) <= budget
        first = squares.argmax(1) == block
        kept.append((u[first], v[first]))
    if not kept:
        return i[:0], j[:0]
    return tuple(np.concatenate(side) for side in zip(*kept))


def _hang(i: np.ndarray, j: np.ndarray, nodes: int) -> np.ndarray:
    """Smallest node that each node hangs together with, along the links (i, j)."""
    label = np.arange(nodes)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_duplicates(
    vectors: DataFrame,
    cosine: float = 0.98,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(key, n_links, component_id, kept) for every row.

    Two rows link when their labels are equal and not null, their vectors have as many components,
    and the cosine in double precision is at least ``cosine``. Vectors that are null, empty, zero or
    hold a null or a non-finite component link with nothing. Rows that agree in key are one node,
    and never each other's links; each is returned. A row without key is left out of links, its
    component is null and it is kept. An empty table gives an empty result; other columns are not read.

    A cell with many vectors is cut into tiles that meet in pairs, so a label, or a group of near
    copies, that holds a third of all rows is spread over many tasks.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be above 0 and at most 1")
    named = vectors.select(F.col(key).alias(key), F.col(label).alias("label"), F.col(vector).alias("vector"))
    sound = (
        named.where(F.col(key).isNotNull() & F.col("label").isNotNull() & _valid("vector"))
        .dropDuplicates()
        .withColumn("dims", F.size("vector"))
    )
    sound = stored(sound, "vectors")
    # Along how many dimensions the cells of a label are cut.
    sizes = sound.groupBy("label", "dims").agg(F.count("*").alias("rows"))
    grid = F.ceil(F.log2(F.col("rows") / CELL))
    cuts = sizes.select(
        "label",
        "dims",
        F.greatest(F.lit(0), F.least(F.lit(BLOCK), F.col("dims"), grid)).cast("int").alias("grid"),
    )
    placed = stored(_placed(sound, stored(cuts, "grids"), 2 - 2 * cosine, key), "cells")
    cell = ["label", "dims", "block", "cell"]
    tiles = stored(
        placed.groupBy(*cell)
        .agg(F.count_if(~F.col("probe")).alias("homes"), F.count_if("probe").alias("probes"))
        # A cell where nothing lies, or where only what lies there is sought, once, finds nothing.
        .where("homes > 0 and homes + probes > 2")
        .select(
            *cell,
            F.ceil(F.col("homes") / TILE).cast("int").alias("home_tiles"),
            F.ceil(F.col("probes") / TILE).cast("int").alias("probe_tiles"),
        ),
        "tiles",
    )
    # A probe goes to every tile of homes, a home to every tile of probes.
    mine = F.pmod(F.xxhash64(key, "probe"), F.when(F.col("probe"), F.col("probe_tiles")).otherwise(F.col("home_tiles")))
    others = F.sequence(F.lit(0), F.when(F.col("probe"), F.col("home_tiles")).otherwise(F.col("probe_tiles")) - 1)
    dealt = (
        placed.join(tiles, cell)
        .withColumn("mine", mine.cast("int"))
        .withColumn("other", F.explode(others))
        .withColumn("home_tile", F.when(F.col("probe"), F.col("other")).otherwise(F.col("mine")))
        .withColumn("probe_tile", F.when(F.col("probe"), F.col("mine")).otherwise(F.col("other")))
    )
    group = [*cell, "home_tile", "probe_tile"]
    kind = named.schema[key].dataType
    schema = T.StructType().add(key, kind).add("links", "long").add("root", kind)

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({key: rows[key][:0], "links": np.zeros(0, np.int64), "root": rows[key][:0]})
        seeks, lies = rows[rows["probe"]], rows[~rows["probe"]]
        if not len(seeks) or not len(lies):
            return none
        a, b = seeks[key].to_numpy(), lies[key].to_numpy()
        x, y = unit_vectors(seeks["vector"].tolist()), unit_vectors(lies["vector"].tolist())
        i, j = linked_pairs(x, y, int(rows["block"].iloc[0]), cosine)
        other = a[i] != b[j]
        i, j = i[other], j[other]
        if not len(i):
            return none
        ids, where = np.unique(np.concatenate([a, b]), return_inverse=True)
        u, v = where[i], where[len(a) + j]
        # Rows that agree in key count once: pairs of keys, not of rows.
        pairs = np.unique(np.stack([u, v], 1), axis=0)
        links = np.bincount(pairs[:, 0], minlength=len(ids))
        root = _hang(u, v, len(ids))
        use = np.flatnonzero((links > 0) | (root != np.arange(len(ids))))
        return pd.DataFrame({key: ids[use], "links": links[use], "root": ids[root[use]]})

    met = stored(
        dealt.select(*group, "probe", key, "vector").groupBy(group).applyInPandas(meet, schema), "met"
    )
    counts = met.groupBy(key).agg(F.sum("links").alias("n_links"))
    whole = connected(met.select(key, "root")).toDF(key, "component_id")
    component = F.coalesce("component_id", key)
    return (
        named.select(key)
        .join(stored(counts, "link-counts"), key, "left")
        .join(stored(whole, "vector-components"), key, "left")
        .select(
            key,
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col(key) == component, F.lit(True)).alias("kept"),
        )
    )
