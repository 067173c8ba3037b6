"""Vectors that nearly agree, against all pairs."""

import numpy as np
import pytest
from wayfare.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, n_links long, dims int"


def plain(data, cosine):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v):
            return None
        v = np.array(v, np.float32).astype(float)
        return v / np.linalg.norm(v) if np.any(v) else None

    vectors = [unit(v) for _, v, *_ in data]
    parent = {d[0]: d[0] for d in data if d[0] is not None}
    links = {i: set() for i in parent}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, _, label, *_) in enumerate(data):
        for m in range(k):
            j = data[m][0]
            if None in (i, j, label) or i == j or label != data[m][2]:
                continue
            x, y = vectors[k], vectors[m]
            if x is not None and y is not None and len(x) == len(y) and x @ y >= cosine:
                links[i].add(j)
                links[j].add(i)
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return sorted(
        repr((i, len(links.get(i, ())), None if i is None else find(i), True if i is None else find(i) == i))
        for i, *_ in data
    )


def made(dims=64, families=12, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for family in range(families):
        base = rng.standard_normal(dims)
        base /= np.linalg.norm(base)
        for _ in range(int(rng.integers(1, 25))):
            noise = rng.standard_normal(dims)
            scale = rng.choice([0.0, 0.05, 0.1, 0.14, 0.2, 0.3])
            v = base + scale * noise / np.linalg.norm(noise)
            rows.append((v * rng.choice([1, 7, 1e-3])).astype(np.float32).tolist())
    return rows


ODD = [
    None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [float("inf")] * 64, [None] + [1.0] * 63, [1.0, 2.0], [2.0, 4.0],
    [3.0], [1e-30] * 64, [1e30] * 64, [-1e30] * 64,
]


@pytest.mark.parametrize(("cell", "tile"), [(4096, 1024), (4, 7)])
def test_all_pairs(spark, monkeypatch, cell, tile):
    monkeypatch.setattr(embeddings, "CELL", cell)
    monkeypatch.setattr(embeddings, "TILE", tile)
    vectors = made() + ODD
    data = [(k, v, [1, 1, 2, None][k % 4], 9, 9) for k, v in enumerate(vectors)]
    data += [(1000 + k, v, 5, 9, 9) for k, v in enumerate(ODD + [vectors[0]] * 30)]
    data += [(None, vectors[0], 1, 0, 0), data[0], (3, vectors[1], 1, 0, 0)]
    got = embeddings.near_duplicates(spark.createDataFrame(data, SCHEMA)).collect()
    assert sorted(repr(tuple(r)) for r in got) == plain(data, 0.98)
    assert sum(r.n_links > 0 for r in got) > 50


def test_empty_table(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_every_pair_counts_in_one_block():
    vectors = embeddings.unit_vectors(made(seed=3))
    n = len(vectors)
    total = np.zeros((n, n), int)
    for block in range(len(embeddings.blocks_of(64))):
        i, j = embeddings.linked_pairs(vectors, vectors, block, 0.98)
        np.add.at(total, (i, j), 1)
    near = vectors @ vectors.T
    sure = np.abs(near - 0.98) > 1e-12
    assert ((total == 1) == (near >= 0.98))[sure].all() and total.max() == 1
