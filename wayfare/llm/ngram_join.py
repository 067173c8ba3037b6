"""Exact Jaccard join of texts on word n-grams, by signature trees.

Shingles are 64-bit hashes. A signature tree has nodes that know, of the documents below them, the
OR of their token bitmaps and the range of their sizes; from two nodes follows how much any two
documents below them can have in common at most, and pairs of nodes that cannot reach the
threshold are never opened. One tree over unrelated documents would be useless, since the OR of a few
of them has every bit set. So the top of the tree is dealt by the tokens themselves:

* Two sets of similarity ``t`` whose smaller one has ``a`` members differ in at most
  ``d = a * (1 - t) / t`` members. The hash range is cut into ``m > d`` parts; then the sets agree
  on ``m - d`` parts at least. A top node holds the documents of one range of sizes that agree on one
  part: for any two top nodes of a part the overlap in it is short of whole, and if that
  holds in all parts, the pair cannot link. Linked documents therefore meet in a top node.
* Unrelated documents would meet in parts that are empty in both. There are a quarter more parts than
  the bound asks for, so nearly every set has fewer empty parts than it shares with a linked one, and
  is in no top node for them. If two sets share empty parts alone, both have that many, and both are.
* In a top node every document is first compared with one head. What links hangs together.
* Nodes whose documents hang together already are closed. The others are opened, those with the same
  head as one node where that takes less, since they hold much the same documents: tiles of documents
  with their bitmaps and sizes, pairs of tiles, and within a pair of tiles smaller nodes, down to
  pairs of documents that hang on different components and may overlap enough.
* These pairs are compared exactly, shingle by shingle.

Links inside a component that hangs together need no comparison, so a family of near copies costs
its size, not its square, and no link that joins two components is missed.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.components import connected
from wayfare.llm.text import stored

BAND = 1.4  # sizes of one range of a top node
BITS = 1024
WORDS64 = BITS // 64
TILE = 512  # documents of a tile
LEAF = 16  # documents of a smallest node
ROWS = 512
FILTER_BITS = 1 << 23  # of the map that thins out texts: 131,072 rows of 64 bits
SEGMENT = 1 << 20  # bytes hashed at once
TOGETHER = 1 << 18  # bytes of short texts hashed together
SPARE = 6  # bits of a short hash beyond those that number the shingles of a set
SEEN = 500_000  # copies that one task leaves out
ROW_COST = 200  # comparisons of bitmaps that take as long as dealing a document with its maps

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = 0x9E3779B97F4A7C15 | 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _STEP, np.uint64)
    up[0] = 1
    down = np.full(size, pow(_STEP, -1, 1 << 64), np.uint64)
    down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of every word of UTF-8 bytes, in order."""
    found = []
    at = 0
    while at < len(data):
        end = min(len(data), at + SEGMENT)
        if end < len(data):  # cut at white space
            cut = max(data.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
            if cut > at:
                end = cut
            else:  # one word longer than a segment
                piece = data[at:].split(None, 1)
                end = len(data) - len(piece[1]) if len(piece) > 1 else len(data)
        raw = np.frombuffer(data, np.uint8, end - at, at)
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = ~_SPACE[raw]
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        if len(starts):
            size = max(SEGMENT, 1 << (len(raw) - 1).bit_length()) + 1
            up, down = _powers(size)
            sums = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(_LETTER[raw] * up[: len(raw)], out=sums[1:])
            found.append(mix64((sums[ends] - sums[starts]) * down[starts]))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; the whole sequence is one if words are fewer."""
    return next(shingle_sets([text], width))


def _combined(words: np.ndarray, n: int, width: int) -> np.ndarray:
    """Hashes of the first ``n`` runs of ``width`` words."""
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = mix64(out * np.uint64(_STEP) + words[k : k + n])
    return out


def _set_of(words: np.ndarray, width: int) -> np.ndarray:
    if not len(words):
        return np.zeros(0, np.uint64)
    width = min(width, len(words))
    return np.unique(_combined(words, len(words) - width + 1, width))


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """The sets of many texts; short texts are hashed together."""
    at = 0
    while at < len(texts):
        group: list[bytes] = []
        size = 0
        while at < len(texts) and size < TOGETHER:
            data = (texts[at] or "").encode("utf-8", "surrogatepass").lower()
            if len(data) > TOGETHER and group:
                break
            group.append(data)
            size += len(data) + 1
            at += 1
        if len(group) == 1:
            yield _set_of(word_hashes(group[0]), width)
            continue
        joined = b"\n".join(group)
        words = word_hashes(joined)
        # How many words begin in front of each text's end.
        inside = ~_SPACE[np.frombuffer(joined, np.uint8)]
        inside[1:] &= ~inside[:-1]
        begun = np.concatenate(([0], np.cumsum(inside)))
        ends = begun[np.cumsum([len(g) + 1 for g in group]) - 1]
        counts = np.diff(ends, prepend=0)
        n = max(0, len(words) - width + 1)
        all_shingles = _combined(words, n, width)
        start = 0
        for count in counts.tolist():
            if count >= width:
                yield np.unique(all_shingles[start : start + count - width + 1])
            else:
                yield _set_of(words[start : start + count], width)
            start += count


def fingerprint(shingles: np.ndarray) -> int:
    """One signed 64-bit value for a set."""
    total = mix64(shingles + np.uint64(_STEP)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mix64(np.array([total], np.uint64)).view(np.int64)[0])


class Parts:
    """Which parts of a set decide where it meets others, for a similarity of num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.starts = [1]
        while self.starts[-1] < 1 << 40:
            self.starts.append(max(self.starts[-1] + 1, int(self.starts[-1] * BAND)))

    def band(self, size: int) -> int:
        return bisect_right(self.starts, size) - 1

    @lru_cache(maxsize=256)
    def cuts(self, band: int) -> tuple[np.ndarray, int] | None:
        """Borders of the parts, and on how many linked sets agree at least; None where only equal
        sets can link."""
        largest = self.starts[band + 1] - 1
        differ = largest * (self.den - self.num) // self.num
        if not differ:
            return None
        agree = 1 + (differ + 3) // 4
        n = differ + agree
        return np.array([-(-(i << 64) // n) for i in range(1, n)], np.uint64), agree

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        n = len(shingles)
        smallest = -(-n * self.num // self.den)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix64(shingles ^ np.uint64(_STEP)), out=sums[1:])
        found = []
        for band in range(self.band(max(1, smallest)), self.band(n) + 1):
            cuts = self.cuts(band)
            if cuts is not None:
                at = np.concatenate(([0], np.searchsorted(shingles, cuts[0]), [n]))
                part = np.arange(len(at) - 1, dtype=np.uint64) + np.uint64(band << 32)
                keys = mix64(sums[at[1:]] - sums[at[:-1]] + mix64(part))
                held = at[1:] > at[:-1]
                found.append(keys[held] if len(held) - held.sum() < cuts[1] else keys)
        return np.concatenate(found) if found else np.zeros(0, np.uint64)


def fingerprints(docs: DataFrame, text: str, key: str, width: int) -> DataFrame:
    """(id, n, f, surplus, bits, wide, fine) for every row: size of its set, the value that stands for
    the set, its bitmap, how many shingles it has beyond the bits set, a map that grows with the set,
    and its shingles by short hashes."""
    schema = docs.select(F.col(key).alias("id")).schema
    schema = schema.add("n", T.LongType()).add("f", T.LongType()).add("surplus", T.LongType())
    schema = schema.add("bits", T.ArrayType(T.LongType())).add("wide", T.ArrayType(T.LongType())).add("fine", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                sets = list(shingle_sets(batch.column(1).to_pylist(), width))
                n = np.array([len(s) for s in sets], np.int64)
                bits = np.stack([bitmap(s) for s in sets])
                surplus = n - np.bitwise_count(bits.view(np.uint64)).sum(1, dtype=np.int64)
                ends = np.arange(0, bits.size + 1, WORDS64, dtype=np.int32)
                columns = [
                    pa.array(n),
                    pa.array([fingerprint(s) for s in sets], pa.int64()),
                    pa.array(surplus),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(bits.ravel())),
                ]
                wide = [wide_bitmap(s) for s in sets]
                ends = np.concatenate(([0], np.cumsum([len(w) for w in wide]))).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(wide))))
                columns.append(pa.array([short_hashes(s).tobytes() for s in sets], pa.binary()))
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def part_keys(docs: DataFrame, text: str, width: int, parts: tuple[int, int]) -> DataFrame:
    """(part, f) of every distinct set: the top nodes it belongs to. Copies come from several tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, seen = Parts(*parts), set()
        for batch in batches:
            keys, prints = [], []
            for shingles in shingle_sets(batch.column(0).to_pylist(), width):
                f = fingerprint(shingles)
                if not len(shingles) or f in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(f)
                own = made.keys(shingles)
                keys.append(own)
                prints.append(np.full(len(own), f, np.int64))
                if sum(map(len, keys[-64:])) > 200_000 or len(keys) >= 512:
                    yield _key_rows(keys, prints)
                    keys, prints = [], []
            if keys:
                yield _key_rows(keys, prints)

    return docs.select(F.col(text)).mapInArrow(run, "part long, f long")


def _key_rows(*columns: list) -> pa.RecordBatch:
    """Rows (part, f) from lists of arrays."""
    joined = [pa.array(np.concatenate([np.zeros(0, np.int64), *(a.view(np.int64) for a in c)])) for c in columns]
    return pa.RecordBatch.from_arrays(joined, ["part", "f"])


def shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (part, f) in order, each once, those whose part has several sets.

    A row stays if the one before or behind it has the same part; of a batch only the last row waits.
    """
    part, f = np.zeros(0, np.int64), np.zeros(0, np.int64)  # the row that waits
    met = False  # whether the row before it has its part
    for batch in batches:
        if not batch.num_rows:
            continue
        part, f = (np.concatenate([x, batch.column(k).to_numpy()]) for k, x in enumerate((part, f)))
        new = np.concatenate(([True], (part[1:] != part[:-1]) | (f[1:] != f[:-1])))
        part, f = part[new], f[new]
        same = part[1:] == part[:-1]
        before = np.concatenate(([met], same))
        keep = before[:-1] | same
        if keep.any():
            yield _key_rows([part[:-1][keep]], [f[:-1][keep]])
        part, f, met = part[-1:], f[-1:], bool(before[-1])
    if met:
        yield _key_rows([part], [f])


def bitmap(shingles: np.ndarray, size: int = BITS) -> np.ndarray:
    """Bit of each shingle's hash; as signed 64-bit words. Sizes are powers of two: a map folds
    onto a smaller one, its halves laid over each other."""
    bits = np.zeros(size, np.uint8)
    bits[(mix64(shingles) & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def wide_bitmap(shingles: np.ndarray) -> np.ndarray:
    """A map with a bit or two for each shingle, so that large sets differ in it as well."""
    return bitmap(shingles, max(BITS, 1 << (len(shingles) - 1).bit_length()) if len(shingles) else BITS)


def hash_bits(n: int) -> int:
    """Of a short hash in a set of n: so many that a hash is free with a chance of a hundredth or so."""
    return max(8, n.bit_length() + SPARE)


def short_hashes(shingles: np.ndarray) -> np.ndarray:
    """Distinct hashes of ``hash_bits`` bits in order, as bytes: the differences, where 255 says that
    the difference goes on in the next byte. A byte and a bit for each shingle."""
    short = np.unique(mix64(shingles) & np.uint64((1 << hash_bits(len(shingles))) - 1)).astype(np.int64)
    steps = np.diff(short, prepend=0)
    ends = np.cumsum(steps // 255 + 1)
    coded = np.full(ends[-1] if len(ends) else 0, 255, np.uint8)
    coded[ends - 1] = steps % 255
    return coded


def read_hashes(coded: bytes) -> np.ndarray:
    steps = np.frombuffer(coded, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255]


def near_by_hashes(
    pairs: np.ndarray, fine: list[bytes], n: np.ndarray, parts: tuple[int, int]
) -> np.ndarray:
    """Which pairs (i, j) may be similar enough: at most as many shingles are common as short hashes
    are, and as many more as a set lost to equal hashes."""
    num, den = parts
    keep = np.zeros(len(pairs), bool)
    read: dict[int, np.ndarray] = {}
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    mark, last = np.zeros(0, bool), -1
    for at in order.tolist():
        i, j = pairs[at].tolist()
        for k in (i, j):
            if k not in read:
                read[k] = read_hashes(fine[k])
        own, other = read[i], read[j]
        bits = min(hash_bits(int(n[i])), hash_bits(int(n[j])))
        if i != last or len(mark) != 1 << bits:  # a shorter hash is the end of a longer one
            mark, last = np.zeros(1 << bits, bool), i
            mark[own & (len(mark) - 1)] = True
        # Hashes of j that i has too, and the shingles of j that have no hash of their own.
        most = int(mark[other & (len(mark) - 1)].sum()) + int(n[j]) - len(other)
        keep[at] = (num + den) * most >= num * (int(n[i]) + int(n[j]))
    return keep


def most_common(x: np.ndarray, n: int, y: np.ndarray, m: int) -> int:
    """How many shingles two sets, of sizes n and m, have in common at most, by their maps."""
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    surplus = min(n - int(np.bitwise_count(x).sum()), m - int(np.bitwise_count(y).sum()))
    return int(np.bitwise_count(x & y).sum()) + surplus


def _common_bits(x: str, y: str) -> Column:
    both = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(q)).cast("long"))
    return F.aggregate(both, F.lit(0).cast("long"), lambda s, k: s + k)


def _plausible(pairs: DataFrame, signatures: DataFrame, parts: tuple[int, int]) -> DataFrame:
    """The pairs (f, g) that sizes and wide bitmaps leave possible."""
    num, den = parts
    left = signatures.select("f", F.col("n").alias("f_n"), F.col("wide").alias("x"))
    right = signatures.select(F.col("f").alias("g"), F.col("n").alias("g_n"), F.col("wide").alias("y"))
    sizes = (den * F.col("f_n") >= num * F.col("g_n")) & (den * F.col("g_n") >= num * F.col("f_n"))
    first = stored(pairs.join(left.hint("merge"), "f"), "pair-bits")
    both = first.join(right.hint("merge"), "g").where(sizes).select("f", "g", "f_n", "g_n", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            maps, at = [], []
            for k in (4, 5):
                lists = batch.column(k)
                maps.append(lists.values.to_numpy().view(np.uint64))
                at.append(lists.offsets.to_pylist())
            keep = []
            for i in range(batch.num_rows):
                x, y = (maps[k][at[k][i] : at[k][i + 1]] for k in (0, 1))
                keep.append((num + den) * most_common(x, n[i], y, m[i]) >= num * (n[i] + m[i]))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["f", "g"])

    return both.mapInArrow(run, "f long, g long")


def _own_texts(held: DataFrame, width: int) -> DataFrame:
    """The rows (f, text) whose text has that set: a key may come with several texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), width)
            own = [fingerprint(s) == f for f, s in zip(batch.column(0).to_pylist(), sets)]
            yield batch.filter(pa.array(own, pa.bool_()))

    return held.mapInArrow(run, "f long, text string")


def _hit(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Adds ``hit``: whether the id of a row may be one of ``ids``. True for all of these, and for
    others as far as their hashes meet.

    The map has a fixed size and goes to every task. It keeps most texts out of the shuffle that
    follows as long as few ids are wanted, and does no harm beyond.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    bit = F.expr("shiftleft(1L, CAST(place % 64 AS INT))")
    words = (
        ids.select(place.alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(bit).alias("map"))
    )
    marked = rows.withColumn("place", place).join(
        F.broadcast(stored(words, "filter")), F.shiftright("place", 6) == F.col("word"), "left"
    )
    hit = F.coalesce(F.col("map").bitwiseAND(bit) != 0, F.lit(False))
    return marked.withColumn("hit", hit).drop("place", "word", "map")


def _texts_of(pairs: DataFrame, named: DataFrame, known: DataFrame, width: int) -> DataFrame:
    """(f, text) for every set in the pairs, from one of the rows that have it."""
    wanted = pairs.select("f").union(pairs.select("g")).distinct()
    holders = known.where("id is not null").groupBy("f").agg(F.min("id").alias("id"))
    holders = stored(holders.join(wanted, "f"), "holders")
    near = _hit(named, holders).where("hit").drop("hit")
    held = near.join(holders.hint("merge"), "id").select("f", "text")
    return stored(_own_texts(held, width).dropDuplicates(["f"]), "texts")


def _verified(pairs: DataFrame, texts: DataFrame, width: int, parts: tuple[int, int]) -> DataFrame:
    """The pairs (f, g) whose sets are similar enough, compared shingle by shingle."""
    num, den = parts
    left = texts.select("f", F.col("text").alias("a"))
    right = texts.select(F.col("f").alias("g"), F.col("text").alias("b"))
    # The same plan at every size: sorted joins, of stored tables, which Spark may split.
    first = stored(pairs.join(left.hint("merge"), "f"), "pair-texts")
    both = first.join(right.hint("merge"), "g").select("f", "g", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: dict[int, np.ndarray] = {}

        def shingles(f: int, text: str) -> np.ndarray:
            if f not in recent:
                if len(recent) >= 64:
                    recent.clear()
                recent[f] = shingle_set(text, width)
            return recent[f]

        for batch in batches:
            good = []
            rows = zip(*(batch.column(k).to_pylist() for k in range(4)))
            for f, g, a, b in rows:
                x, y = shingles(f, a), shingles(g, b)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if den * common >= num * (len(x) + len(y) - common):
                    good.append((f, g))
            if good:
                columns = [pa.array([p[k] for p in good], pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, ["f", "g"])

    return both.mapInArrow(run, "f long, g long")


class Side(NamedTuple):
    """Documents of a tile: set, size, component, bitmap."""

    f: np.ndarray
    n: np.ndarray
    comp: np.ndarray
    bits: np.ndarray


def may_link(a: Side, b: Side, parts: tuple[int, int]) -> np.ndarray:
    """Pairs (f of a, f of b) that may be similar enough and hang on different components.

    The dual traversal of two tiles: pairs of nodes first, then the documents below them. At most
    as many shingles are common as common bits are set, plus those of the smaller surplus of shingles
    over bits.
    """
    num, den = parts
    few = len(a.f) * len(b.f) <= LEAF * LEAF
    sides = []
    for side in (a, b):
        if not few:
            order = np.lexsort((side.f, side.n, side.comp))
            side = Side(*(column[order] for column in side))
        n, comp, bits = side.n, side.comp, side.bits
        surplus = n - np.bitwise_count(bits).sum(1, dtype=np.int64)
        docs = {"bits": bits, "low": n, "high": n, "surplus": surplus, "comp_low": comp, "comp_high": comp}
        nodes = docs
        if not few:
            heads = np.arange(0, len(n), LEAF)
            nodes = {
                "bits": np.bitwise_or.reduceat(bits, heads),
                "low": np.minimum.reduceat(n, heads),
                "high": np.maximum.reduceat(n, heads),
                "surplus": np.maximum.reduceat(surplus, heads),
                "comp_low": np.minimum.reduceat(comp, heads),
                "comp_high": np.maximum.reduceat(comp, heads),
            }
        sides.append((side.f, docs, nodes))

    def possible(x: dict, y: dict, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs (i, j) of nodes are worth opening."""
        same = (x["comp_low"][i] == x["comp_high"][i]) & (x["comp_low"][i] == y["comp_high"][j])
        same &= y["comp_low"][j] == y["comp_high"][j]
        low, high = x["low"][i], y["low"][j]
        sizes = (den * x["high"][i] >= num * high) & (den * y["high"][j] >= num * low)
        keep = np.flatnonzero(~same & sizes)
        i, j = i[keep], j[keep]
        common = np.bitwise_count(x["bits"][i] & y["bits"][j]).sum(1, dtype=np.int64)
        most = common + np.minimum(x["surplus"][i], y["surplus"][j])
        # common / (a + b - common) >= num / den
        return keep[(num + den) * most >= num * (x["low"][i] + y["low"][j])]

    (f, x, top_x), (g, y, top_y) = sides
    if few:
        p, q = np.repeat(np.arange(len(f)), len(g)), np.tile(np.arange(len(g)), len(f))
        good = possible(x, y, p, q)
        return np.stack([f[p[good]], g[q[good]]], 1)
    found = []
    for i in range(len(top_x["low"])):
        j = np.arange(len(top_y["low"]))
        open_j = j[possible(top_x, top_y, np.full(len(j), i), j)]
        if not len(open_j):
            continue
        own = np.arange(i * LEAF, min((i + 1) * LEAF, len(f)))
        other = (open_j[:, None] * LEAF + np.arange(LEAF)).ravel()
        other = other[other < len(g)]
        p, q = np.repeat(own, len(other)), np.tile(other, len(own))
        good = possible(x, y, p, q)
        found.append(np.stack([f[p[good]], g[q[good]]], 1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _whole_groups(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[pa.Table]:
    """Sorted rows again, in tables that no group runs across."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        keys = [held.column(c).to_numpy() for c in group]
        same = np.all([k == k[-1] for k in keys], axis=0)
        last = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if last:
            yield held.slice(0, last)
            held = held.slice(last)
    if held is not None:
        yield held


def _short_hashes_of(sets: DataFrame, known: DataFrame) -> DataFrame:
    """(f, fine) of the given sets; only they are shuffled, and those whose hashes meet theirs."""
    wanted = stored(sets.select(F.col("f").alias("id")).distinct(), "open-sets")
    near = _hit(known.where("n > 0").select(F.col("f").alias("id"), "fine"), wanted).where("hit")
    return near.join(wanted.hint("merge"), "id").select(F.col("id").alias("f"), "fine").dropDuplicates(["f"])


def _opened(
    members: DataFrame, hung: DataFrame, signatures: DataFrame, known: DataFrame, parts: tuple[int, int]
) -> DataFrame:
    """Pairs (f, g) from the top nodes whose documents do not hang together yet.

    A document meets its relatives in many nodes, mostly with the same head. Nodes of one head are
    opened as one, with each document once, unless the pairs this adds cost more than the rows it saves.
    """
    num, den = parts
    on = members.join(hung.toDF("f", "comp").hint("merge"), "f", "left").withColumn(
        "comp", F.coalesce("comp", "f")
    )
    on = stored(on, "hung")
    broken = stored(
        on.groupBy("part")
        .agg(
            F.min("comp").alias("low"),
            F.max("comp").alias("high"),
            F.min("head").alias("head"),
            F.count("*").cast("double").alias("rows"),
        )
        .where("low < high")
        .select("part", "head", "rows"),
        "open-nodes",
    )
    rows = stored(on.join(broken.select("part").hint("merge"), "part"), "open-members")

    def cost(n: str) -> Column:
        return F.col(n) * (F.col(n) + ROW_COST)

    apart = broken.groupBy("head").agg(F.sum(cost("rows")).alias("apart"))
    whole = rows.select("head", "f").distinct().groupBy("head").agg(F.count("*").cast("double").alias("sets"))
    merged = stored(
        apart.join(whole.hint("merge"), "head").where(cost("sets") <= F.col("apart")).select("head", F.lit(True).alias("one")),
        "merged-heads",
    )
    rows = stored(
        rows.join(merged.hint("merge"), "head", "left")
        .withColumn("part", F.when(F.col("one"), F.col("head")).otherwise(F.col("part")))
        .select("part", "f", "comp", "head_comp")
        .distinct(),
        "merged-members",
    )
    sizes = stored(rows.groupBy("part").agg(F.count("*").alias("rows")), "node-sizes")
    rows = rows.join(sizes.hint("merge"), "part")
    # The component of the head usually holds nearly all; only the others need partners.
    rows = rows.withColumn("main", F.col("comp") == F.col("head_comp"))
    tile = F.pmod(F.xxhash64("f"), F.ceil(F.col("rows") / TILE).cast("long"))
    rows = stored(rows.withColumn("tile", tile), "open-rows")
    maps = signatures.select("f", "n", "surplus", "bits").join(_short_hashes_of(rows, known), "f")
    rows = rows.join(maps.hint("merge"), "f").select(
        "part", "f", "n", "comp", "main", "surplus", "bits", "fine", "tile"
    )
    rows = stored(rows, "tiles")
    words = [F.bit_or(F.get("bits", F.lit(k))).alias(f"w{k}") for k in range(WORDS64)]
    nodes = (
        rows.groupBy("part", "main", "tile")
        .agg(
            F.min("n").alias("low"),
            F.max("n").alias("high"),
            F.max("surplus").alias("surplus"),
            *words,
        )
        .select(
            "part", "main", "tile", "low", "high", "surplus",
            F.array(*[f"w{k}" for k in range(WORDS64)]).alias("bits"),
        )
    )
    nodes = stored(nodes, "tile-nodes")
    x, y = nodes.alias("x"), nodes.alias("y")
    common = _common_bits("x.bits", "y.bits")
    pairs = x.where(~F.col("x.main")).join(
        y,
        (F.col("x.part") == F.col("y.part"))
        & (F.col("y.main") | (F.col("x.tile") <= F.col("y.tile")))
        & (den * F.col("x.high") >= num * F.col("y.low"))
        & (den * F.col("y.high") >= num * F.col("x.low"))
        & (
            (num + den) * (common + F.least("x.surplus", "y.surplus"))
            >= num * (F.col("x.low") + F.col("y.low"))
        ),
    )
    pairs = stored(
        pairs.select(
            F.col("x.part").alias("part"),
            F.col("x.tile").alias("tile"),
            F.col("y.main").alias("other_main"),
            F.col("y.tile").alias("other_tile"),
        ),
        "tile-pairs",
    )
    pairs = pairs.hint("merge")
    own = rows.where(~F.col("main")).join(pairs, ["part", "tile"])
    other = rows.withColumnsRenamed({"main": "other_main", "tile": "other_tile"}).join(
        pairs, ["part", "other_main", "other_tile"]
    )
    group = ["part", "tile", "other_main", "other_tile"]
    kept = [*group, "f", "n", "comp", "bits", "fine"]
    both = own.select(*kept, F.lit(True).alias("own")).union(
        other.select(*kept, F.lit(False).alias("own"))
    )

    # The rows of a group lie together in one partition; a group is two tiles, so it is small.
    dealt = both.repartition(*group).sortWithinPartitions(*group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, group):
            keys = [table.column(c).to_numpy() for c in group]
            new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            starts = [0, *(np.flatnonzero(new) + 1).tolist(), table.num_rows]
            own = table.column("own").to_numpy()
            bits = table.column("bits").combine_chunks().flatten().to_numpy()
            rows = Side(
                *(table.column(c).to_numpy() for c in ("f", "n", "comp")),
                bits.reshape(-1, WORDS64).view(np.uint64),
            )
            fine = table.column("fine").to_pylist()

            found = []
            for start, stop in zip(starts, starts[1:]):
                group_rows = [column[start:stop] for column in rows]
                mine = own[start:stop]
                if mine.any() and not mine.all():
                    a, b = (Side(*(column[side] for column in group_rows)) for side in (mine, ~mine))
                    pairs = may_link(a, b, parts)
                    # Short hashes decide here, so that hardly more than links leaves the task.
                    at = {f: start + k for k, f in enumerate(group_rows[0].tolist())}
                    places = np.array([(at[f], at[g]) for f, g in pairs.tolist()], np.int64).reshape(-1, 2)
                    found.append(pairs[near_by_hashes(places, fine, rows.n, parts)])
            if found:
                pairs = np.concatenate(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["f", "g"]
                )

    met = dealt.mapInArrow(run, "f long, g long")
    return met.where("f != g").select(
        F.least("f", "g").alias("f"), F.greatest("f", "g").alias("g")
    ).distinct()


def jaccard_components(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    width: int = 5,
    similarity: tuple[int, int] = (80, 100),
) -> DataFrame:
    """(key, n_shingles, component_id) for every row; links are exact.

    A text is lower-cased in A-Z and cut into words at ASCII white space; its set is that of its
    distinct shingles of ``width`` words, or the whole sequence where there are fewer. Two
    texts link where ``den * common >= num * all``. The component is the smallest key reachable by
    links. Null or empty texts have size 0, link with nothing and are their own component; so is a
    row without key, whose component is null and which takes no part in links. Rows that agree in
    key are one node. Equal texts are one set, compared once. An empty table gives an empty result; other
    columns are not read.
    """
    num, den = similarity
    if not 0 < num <= den:
        raise ValueError("similarity is a fraction num / den above 0 and at most 1")
    named = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).where("id is not null")
    known = stored(fingerprints(docs, text, key, width), "fingerprints")  # the texts are read here

    # The keys are made and dealt once; each row is one set in one top node from here on.
    keys = part_keys(named, "text", width, similarity).repartition("part").sortWithinPartitions("part", "f")
    met = stored(keys.mapInArrow(shared_keys, keys.schema), "met")
    tops = met.groupBy("part").agg(
        F.min("f").alias("head"),
        F.max("f").alias("last"),
        F.count("*").alias("rows"),
        F.bit_xor(F.xxhash64("f")).alias("x"),
        F.bit_xor(F.xxhash64("f", F.lit(1))).alias("y"),
    )
    # Sets that agree on much meet in many top nodes; of nodes that hold the same sets one is enough.
    heads = stored(
        tops.groupBy("head", "last", "rows", "x", "y").agg(F.min("part").alias("part")).select("part", "head"),
        "heads",
    )
    members = stored(met.join(heads.hint("merge"), "part"), "members")

    signatures = stored(
        known.where("n > 0").select("f", "n", "surplus", "bits", "wide").dropDuplicates(["f"]),
        "signatures",
    )
    to_head = (
        members.where("f != head")
        .select(F.least("f", "head").alias("f"), F.greatest("f", "head").alias("g"))
        .distinct()
    )

    def linked(found: DataFrame, purpose: str) -> DataFrame:
        pairs = stored(found, purpose)
        texts = _texts_of(pairs, named, known, width)
        return stored(_verified(pairs, texts, width, similarity), "set-links")

    to_head = stored(to_head, "pairs-with-heads")
    first = linked(_plausible(to_head, signatures, similarity), "possible-pairs")
    hung = stored(connected(first), "hung-together")
    heads_hung = hung.toDF("head", "head_comp")
    tagged = (
        members.join(heads_hung.hint("merge"), "head", "left")
        .withColumn("head_comp", F.coalesce("head_comp", "head"))
        .select("part", "f", "head", "head_comp")
    )
    second = linked(_opened(tagged, hung, signatures, known, similarity), "pairs-in-nodes")
    # Sets that hang together hang on their smallest; the new links join these.
    links = hung.where("node != component").toDF("f", "g").union(second)
    groups = stored(connected(links), "set-components").toDF("f", "whole")
    grouped = stored(
        known.join(groups.hint("merge"), "f", "left").select(
            "id", "n", F.when(F.col("n") > 0, F.coalesce("whole", "f")).alias("whole")
        ),
        "grouped",
    )
    smallest = (
        grouped.where("whole is not null and id is not null")
        .groupBy("whole")
        .agg(F.min("id").alias("component_id"))
    )
    return grouped.join(stored(smallest, "smallest").hint("merge"), "whole", "left").select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows of which one of each group of near duplicates stays: that with the smallest key.

    Of rows that agree in the key one stays. Rows without a key, and texts without words, are in no
    group and stay. All columns come back as they were.
    """
    groups = jaccard_components(docs, text, key, **options).toDF("id", "n", "component_id")
    # Keys whose rows do not simply stay: those that give way, and those that come more than once.
    special = stored(
        groups.where("id is not null")
        .groupBy("id")
        .agg(F.count("*").alias("rows"), F.max(F.col("id") == F.col("component_id")).alias("head"))
        .where("rows > 1 or not head")
        .select("id", "head"),
        "special-keys",
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).alias("id")
    )
    marked = _hit(rows, special)
    first = Window.partitionBy("id").orderBy(F.col(f"row.`{text}`"))
    checked = (
        marked.where("hit")
        .join(special.hint("merge"), "id", "left")
        .withColumn("place", F.row_number().over(first))
        .where("head is null or (head and place = 1)")
    )
    return marked.where("not hit").select("row.*").union(checked.select("row.*"))
