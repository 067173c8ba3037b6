"""Mixing: targets by plain water filling, words near the target, edge cases."""

import random
from collections import defaultdict

import pytest
from wayfare.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, place long"


def plain_targets(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    """Share by weight; cut what is above the limit; share the rest again, until nothing is cut."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, open_names = {}, float(sum(sizes.values())), set(names)
    while open_names:
        total = sum(weight[s] for s in open_names)
        over = [s for s in open_names if left * weight[s] / total > most * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in open_names}
            break
        for s in over:
            target[s] = float(most * sizes[s])
            open_names.discard(s)
        left = sum(sizes.values()) - sum(target.values())
    return target


def rows_of(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_targets_and_words(spark):
    rng = random.Random(3)
    data = []
    for k in range(3000):
        source = rng.choice(["a"] * 10 + ["b", "Z", "é", "zz", "", None])
        words = rng.randint(0, 60) if k % 400 else 900
        data.append((k, " ".join(["w"] * words) + "\n", source, "clash", 1))
    data += [(None, None, "b", None, None), (5000, None, None, None, None), (5001, "", "only-empty", "x", 0)]
    got = mixing.mix(rows_of(spark, data)).collect()
    assert len(got) == len(data)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    by_id = {d[0]: d for d in data}
    for r in got:
        text, source = by_id[r.doc_id][1:3]
        assert r.size == len((text or "").split())
        sizes[source] += r.size
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    want = plain_targets(sizes)
    for r in got:
        source = by_id[r.doc_id][2]
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(want[source])
    for source in sizes:
        assert abs(taken[source] - want[source]) <= max(40, 0.01 * want[source])


def test_reruns_agree_and_rows_repeat(spark):
    data = [(k, "x " * (k % 7 + 1), "ab"[k % 5 == 0], "s", 1) for k in range(400)]
    table = rows_of(spark, data + data[:20])
    once = mixing.mix(table).orderBy("doc_id", "taken").collect()
    again = mixing.mix(table.repartition(5)).orderBy("doc_id", "taken").collect()
    assert once == again
    rows = mixing.mixed_rows(table)
    assert rows.columns == table.columns
    words = sum(len(r.text.split()) for r in rows.collect())
    assert words == sum(r.taken for r in once)


def test_empty_table(spark):
    assert mixing.mix(rows_of(spark, [])).collect() == []
    assert mixing.mixed_rows(rows_of(spark, [])).collect() == []


def test_tied_places_are_one_unit(spark):
    data = [(1, "a b c", "s", None, None)] * 50 + [(2, "a", "t", None, None)] * 10
    got = mixing.mix(rows_of(spark, data)).collect()
    assert len({r.taken for r in got if r.doc_id == 1}) == 1
