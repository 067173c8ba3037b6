"""Jaccard join against all pairs, on texts made to differ by little."""

import random

import numpy as np
import pyarrow as pa
import pytest
from wayfare.llm import ngram_join
from wayfare.llm.components import connected

SCHEMA = "doc_id long, text string, id string, part string, f long"


def plain_set(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(zip(*(words[k:] for k in range(width))))


def plain_components(data, width, num, den):
    sets = [plain_set(t, width) for _, t in data]
    parent = {i: i for i, _ in data if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, _) in enumerate(data):
        for m in range(k):
            j = data[m][0]
            if i is None or j is None or not sets[k] or not sets[m]:
                continue
            common = len(sets[k] & sets[m])
            if den * common >= num * (len(sets[k]) + len(sets[m]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [(i, len(s), None if i is None else find(i)) for (i, _), s in zip(data, sets)]


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.5:
            words[at] = f"new{rng.random()}"
        elif kind < 0.75:
            words.insert(at, f"more{rng.random()}")
        elif len(words) > 1:
            del words[at]
    return words


def made_texts():
    """Families around the threshold, chains, copies, a passage in all, short and odd texts."""
    rng = random.Random(11)
    texts = []
    passage = [f"p{k}" for k in range(40)]
    for size in (12, 30, 90, 300):
        for _ in range(3):
            base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            texts.append(base)
            for n in (0, 1, 1, 2, 3, max(1, size // 60), max(1, size // 30)):
                texts.append(changed(rng, base, n))
            chain = base
            for _ in range(6):
                chain = changed(rng, chain, max(1, size // 80))
                texts.append(chain)
            texts.append(passage + base)
    texts = [" ".join(t) for t in texts]
    texts += ["", None, "  \n", "one", "ONE", "one two", "One\ttwo", "é É", "É é", "a a a a a a", "a a a a", "x" * 3_000_000]
    data = list(enumerate(texts))
    rng.shuffle(data)
    return data + [(None, texts[0]), (None, None), data[0], (data[1][0], data[1][1])]


@pytest.mark.parametrize(("width", "similarity"), [(3, (90, 100)), (5, (80, 100))])
def test_all_pairs(spark, monkeypatch, width, similarity):
    monkeypatch.setattr(ngram_join, "TILE", 4)  # so that nodes are cut into tiles
    data = made_texts()
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in data], SCHEMA)
    got = ngram_join.jaccard_components(docs, width=width, similarity=similarity).collect()
    want = plain_components(data, width, *similarity)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert len({c for _, _, c in want}) < len(data) - 30


def test_one_of_each(spark):
    data = made_texts()
    docs = spark.createDataFrame([(i, t, f"own{i}", "y", 1) for i, t in data], SCHEMA)
    rows = ngram_join.one_of_each(docs, width=5, similarity=(80, 100))
    assert rows.columns == docs.columns
    kept = rows.collect()
    heads = {i for i, _, c in plain_components(data, 5, 80, 100) if i is not None and i == c}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(heads)
    assert sum(r.doc_id is None for r in kept) == 2
    assert all(r.id == f"own{r.doc_id}" for r in kept)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert ngram_join.jaccard_components(docs).collect() == []
    assert ngram_join.one_of_each(docs).collect() == []


def test_bounds_never_lose_a_pair():
    """Every pair that is similar enough passes the bounds of the tiles, and few others do."""
    rng = random.Random(4)
    base = [[f"b{b}w{rng.randrange(10**5)}" for _ in range(200)] for b in range(12)]
    texts = [" ".join(changed(rng, words, rng.randint(0, 6))) for words in base for _ in range(8)]
    sets = [ngram_join.shingle_set(t, 3) for t in texts]
    numbers = np.arange(len(sets))
    bits = np.stack([ngram_join.bitmap(s) for s in sets]).view(np.uint64)
    rows = ngram_join.Side(numbers, np.array([len(s) for s in sets]), numbers, bits)
    found = {tuple(sorted(p)) for p in ngram_join.may_link(rows, rows, (90, 100)).tolist()}
    linked = set()
    for i in range(len(sets)):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            if 100 * common >= 90 * (len(sets[i]) + len(sets[j]) - common):
                linked.add((j, i))
    assert linked and linked <= found
    assert len(found) < len(sets) ** 2 / 8


def test_wide_maps_bound_the_overlap():
    rng = random.Random(8)
    for size in (1, 40, 700, 3000):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size + 2)]
        x = ngram_join.shingle_set(" ".join(base), 3)
        for n in (0, 1, size // 20, size // 2, 4 * size):
            y = ngram_join.shingle_set(" ".join(changed(rng, base, n)), 3)
            maps = [ngram_join.wide_bitmap(s).view(np.uint64) for s in (x, y)]
            most = ngram_join.most_common(maps[0], len(x), maps[1], len(y))
            assert most >= len(np.intersect1d(x, y))
        other = ngram_join.shingle_set(" ".join(f"v{k}" for k in range(size + 2)), 3)
        most = ngram_join.most_common(maps[0], len(x), ngram_join.wide_bitmap(other).view(np.uint64), len(other))
        assert size < 700 or most < 0.85 * size


def test_texts_hashed_together_or_alone():
    texts = [t for _, t in made_texts()]
    for width in (1, 3, 5):
        alone = [ngram_join.shingle_set(t, width) for t in texts]
        together = list(ngram_join.shingle_sets(texts, width))
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(alone, together))
        assert [len(s) for s in alone] == [len(plain_set(t, width)) for t in texts]


def test_long_words_and_segments(monkeypatch):
    text = "ab cd " * 500 + "x" * 5000 + " ef\tgh\nab cd"
    whole = ngram_join.word_hashes(text.encode())
    monkeypatch.setattr(ngram_join, "SEGMENT", 64)
    ngram_join._powers.cache_clear()
    assert (ngram_join.word_hashes(text.encode()) == whole).all()
    ngram_join._powers.cache_clear()
    assert len(whole) == len(text.split())


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)]
    links += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7), (None, 3)]
    rng.shuffle(links)
    parent = {x: x for pair in links for x in pair if x is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = dict(map(tuple, connected(spark.createDataFrame(links, "a long, b long")).collect()))
    alone = {x for x in parent if x not in got}
    assert all(not any(x in (a, b) and a != b for a, b in links if a is not None) for x in alone)
    assert got == {x: find(x) for x in got}


@pytest.mark.parametrize("chain", [[2, 5, 4, 3, 1], [1, 2, 5, 4, 6, 3], [1, 3, 4, 6, 5, 2]])
def test_components_of_small_chains(spark, chain):
    # Each alone: a longer one beside it would bring more rounds.
    got = connected(spark.createDataFrame(list(zip(chain, chain[1:])), "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((node, min(chain)) for node in chain)


def test_parts_meet_for_every_linked_pair():
    """Sets just at the threshold, with their differences anywhere, share a key; also small ones, whose
    only common parts may be empty."""
    rng = np.random.default_rng(11)
    for num, den in ((80, 100), (90, 100), (50, 100)):
        made = ngram_join.Parts(num, den)
        for _ in range(400):
            n = int(rng.integers(1, 200))
            x = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            n = len(x)
            drop = int(rng.integers(0, n * (den - num) // den + 1))
            y = x[np.sort(rng.permutation(n)[: n - drop])]
            grow = max(0, den * len(y) // num - n)  # as many as the threshold leaves
            y = np.unique(np.concatenate([y, rng.integers(0, 2**64, int(rng.integers(0, grow + 1)), dtype=np.uint64)]))
            common = len(np.intersect1d(x, y))
            if den * common >= num * (len(x) + len(y) - common) and not np.array_equal(x, y):
                assert len(np.intersect1d(made.keys(x), made.keys(y)))


def test_unrelated_sets_do_not_meet_in_empty_parts():
    rng = np.random.default_rng(12)
    made, met = ngram_join.Parts(80, 100), 0
    keys = [made.keys(np.unique(rng.integers(0, 2**64, 60 + k % 30, dtype=np.uint64))) for k in range(200)]
    for i in range(200):
        for j in range(i):
            met += bool(len(np.intersect1d(keys[i], keys[j])))
    assert met < 200  # of 19,900 pairs; with empty parts nearly all of them met


def test_short_hashes_bound_the_overlap():
    """Never below the true overlap, also between hashes of different lengths, and close to it."""
    rng = np.random.default_rng(13)
    sets = []
    for size in (1, 20, 250, 260, 290, 900, 5000):
        base = rng.integers(0, 2**64, size, dtype=np.uint64)
        for share in (0.5, 0.8, 0.85, 0.9, 0.95, 1.0):
            keep = base[: int(size * share)]
            sets.append(np.unique(np.concatenate([keep, rng.integers(0, 2**64, size - len(keep), dtype=np.uint64)])))
    fine = [ngram_join.short_hashes(s).tobytes() for s in sets]
    n = np.array([len(s) for s in sets])
    pairs = np.array([(i, j) for i in range(len(sets)) for j in range(len(sets)) if i != j])
    for num, den in ((80, 100), (90, 100)):
        got = ngram_join.near_by_hashes(pairs, fine, n, (num, den))
        true = []
        for i, j in pairs:
            common = len(np.intersect1d(sets[i], sets[j]))
            true.append(den * common >= num * (n[i] + n[j] - common))
        true = np.array(true)
        assert got[true].all() and (got & ~true).sum() <= 0.03 * len(pairs)
    for own, coded in zip(sets, fine):
        assert len(ngram_join.read_hashes(coded)) >= 0.97 * len(own) and len(coded) < 1.8 * len(own) + 8


def test_families_below_the_threshold_cost_nothing(spark):
    """A hundred copies with similarity 0.84 of each other give no candidate at 0.9."""
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(100):
        own = list(words)
        for k in rng.sample(range(400), 9):
            own[k] = f"x{rng.random()}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    original = ngram_join._opened
    ngram_join._opened = lambda *a: found.setdefault("pairs", original(*a))
    try:
        got = ngram_join.jaccard_components(docs, width=3, similarity=(90, 100)).collect()
    finally:
        ngram_join._opened = original
    assert len({r.component_id for r in got}) >= 95
    assert found["pairs"].count() <= 20


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 1000])
def test_shared_keys_across_batches(rows):
    """Each set once, and only in parts that it shares, wherever the batches are cut."""
    rng = random.Random(6)
    data = sorted((rng.randrange(-60, 60), rng.randrange(4)) for _ in range(150))
    data = sorted(data + [(70, 1)] * 3 + [(71, 1), (71, 2)])
    table = pa.table({"part": [p for p, _ in data], "f": [f for _, f in data]})
    batches = [b for at in range(0, len(data), rows) for b in table.slice(at, rows).to_batches()]
    got = [tuple(r.values()) for b in ngram_join.shared_keys(iter(batches)) for r in b.to_pylist()]
    sets = {}
    for p, f in data:
        sets.setdefault(p, set()).add(f)
    assert got == sorted((p, f) for p, own in sets.items() if len(own) > 1 for f in own)


def test_opened_nodes_of_one_head_are_dealt_once(spark, monkeypatch):
    """Relatives below the threshold meet in many nodes; each comes with its maps once for a head."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(40):
        own = list(words)
        for k in rng.sample(range(400), 14):
            own[k] = f"x{rng.random()}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts, original = {}, ngram_join.stored

    def counted(df, purpose):
        out = original(df, purpose)
        counts[purpose] = out.count()
        if purpose == "open-nodes":
            counts["members"] = sum(r.rows for r in out.collect())
        return out

    monkeypatch.setattr(ngram_join, "stored", counted)
    got = ngram_join.jaccard_components(docs, width=5, similarity=(80, 100)).collect()
    assert sorted(map(tuple, got)) == sorted(plain_components(list(enumerate(texts)), 5, 80, 100))
    assert counts["members"] > 40 * 40 and counts["tiles"] <= 40 * 40 / 2 + 40
