"""Toxicity by the nearest labelled examples.

A text is a TF-IDF vector over terms that labelled examples show to matter (words, and beginnings of
words), with one more term for all other words together. The nearest examples by exact cosine vote,
the nearer the more, and the share of votes is calibrated on the examples themselves, each scored
without its own vote. The examples used are the evidence.

The index is inverted and cut into blocks of examples. Every term has its largest weight in each
block, which bounds the cosine of all examples there; blocks are read from the highest bound down,
until no other can hold a nearer example.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.text import stored

SAMPLE = 16_000  # labelled rows the model is fitted on, at most about so many
TERMS = 600  # terms of the vectors
MIN_EXAMPLES = 5  # that a term must occur in
HEADS = (4, 5, 6, 7)  # lengths of beginnings of words that are terms
NEAREST = 25  # examples that vote
BLOCK = 64  # distinct examples of a block
PRIOR = 2.0  # votes of the base rate in every score
HELD = 400_000  # terms a task counts before it hands them on
OTHER = 0  # number of the term that stands for all other words

_LETTERS = re.compile(r"[^\W\d_]+")


def word_counts(text: str | None) -> Counter:
    """How often each word (a run of letters, in lower case) occurs."""
    counts: Counter = Counter()
    for token, n in Counter(text.lower().split() if text else ()).items():
        if token.isalpha():
            counts[token] += n
        else:
            for word in _LETTERS.findall(token):
                counts[word] += n
    return counts


def terms_of(word: str) -> list[str]:
    """A word as a whole, and its beginnings, marked as such."""
    return [word, *(word[:n] + "*" for n in HEADS if len(word) > n)]


def _term_counts(examples: DataFrame) -> DataFrame:
    """(term, n, bad): in how many examples, and in how many of label 1, each term occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        bad: Counter = Counter()

        def hand_on() -> pa.RecordBatch:
            columns = [
                pa.array(list(n), pa.string()),
                pa.array(n.values(), pa.int64()),
                pa.array([bad[t] for t in n], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["term", "n", "bad"])

        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {t for word in word_counts(text) for t in terms_of(word)}
                n.update(own)
                if label:
                    bad.update(own)
                if len(n) > HELD:
                    yield hand_on()
                    n.clear()
                    bad.clear()
        if n:
            yield hand_on()

    counted = examples.select("text", "label").mapInArrow(run, "term string, n long, bad long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def _telling(counts: DataFrame, total: int, bad: int, terms: int) -> list[tuple[str, int]]:
    """The terms that go most with label 1, with how many examples hold them."""
    share = bad / max(1, total)
    n, b = F.col("n").cast("double"), F.col("bad").cast("double")
    expected = n * F.lit(share)
    ratio = (b + 0.5) / (expected + 0.5)
    # Likelihood ratio of the counts against independence; only terms more frequent under label 1.
    good = n - b
    score = b * F.log((b + 1e-9) / (expected + 1e-9)) + good * F.log((good + 1e-9) / (n - expected + 1e-9))
    rows = (
        counts.where((F.col("n") >= MIN_EXAMPLES) & (ratio > 2.0))
        .orderBy(F.desc(F.round(score, 6)), "term")
        .limit(terms)
        .collect()
    )
    return [(r["term"], r["n"]) for r in rows]


@dataclass
class Vectorizer:
    """Texts to sparse vectors of length one, over a fixed list of terms."""

    idf: np.ndarray
    number: dict[str, int]
    heads: frozenset[str] = field(default_factory=frozenset)

    @classmethod
    def of(cls, terms: list[tuple[str, int]], total: int) -> Vectorizer:
        idf = np.array([1.0, *(1 + math.log((1 + total) / (1 + n)) for _, n in terms)])
        number = {term: k + 1 for k, (term, _) in enumerate(terms)}
        return cls(idf, number, frozenset(t[: min(HEADS)].rstrip("*") for t in number))

    def counts(self, text: str | None) -> tuple[tuple[int, int], ...]:
        """(term, how often), in order; the frequency of other words by powers of two."""
        found: Counter = Counter()
        other = 0
        shortest = min(HEADS)
        for word, n in word_counts(text).items():
            other += n
            if word[:shortest] in self.heads:
                hit = [self.number[t] for t in terms_of(word) if t in self.number]
                for k in hit:
                    found[k] += n
                other -= n * bool(hit)
        if other:
            found[OTHER] = 1 << (other.bit_length() - 1)
        return tuple(sorted(found.items()))

    def vector(self, counts: tuple[tuple[int, int], ...]) -> tuple[np.ndarray, np.ndarray]:
        if not counts:
            return np.zeros(0, np.int64), np.zeros(0)
        terms = np.array([k for k, _ in counts])
        weights = np.array([(1 + math.log(n)) * self.idf[k] for k, n in counts])
        return terms, weights / math.sqrt(float((weights * weights).sum()))


class BlockMaxIndex:
    """Exact nearest examples by cosine; examples with the same counts are one, with a weight."""

    def __init__(self, vectorizer: Vectorizer, examples: list[tuple[tuple, int, int]]):
        """``examples``: (counts, how many, how many of label 1), distinct counts, none empty."""
        self.size = len(vectorizer.idf)
        # Examples that hold the same strongest terms come to lie in the same blocks.
        vectors = [vectorizer.vector(counts) for counts, _, _ in examples]
        order = sorted(
            range(len(examples)),
            key=lambda k: (sorted(zip(-vectors[k][1], vectors[k][0]))[:3], examples[k][0]),
        )
        self.examples = [examples[k] for k in order]
        self.n = np.array([e[1] for e in self.examples], float)
        self.bad = np.array([e[2] for e in self.examples], float)
        self.starts = list(range(0, len(order), BLOCK))
        self.most = np.zeros((len(self.starts), self.size), np.float32)
        self.blocks: list[tuple[np.ndarray, np.ndarray]] = []
        for b, start in enumerate(self.starts):
            mine = [vectors[k] for k in order[start : start + BLOCK]]
            terms = np.unique(np.concatenate([t for t, _ in mine]))
            dense = np.zeros((len(mine), len(terms)))
            for row, (t, w) in enumerate(mine):
                dense[row, np.searchsorted(terms, t)] = w
            # Rounded up, so that the bound holds.
            self.most[b, terms] = np.nextafter(dense.max(0).astype(np.float32), np.float32(np.inf))
            self.blocks.append((terms, dense))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the nearest examples that are ``count`` rows together, nearest first.

        Examples as near as the last of them are all among them.
        """
        if not len(terms) or not self.blocks:
            return np.zeros(0, np.int64), np.zeros(0)
        bounds = self.most[:, terms].astype(np.float64) @ weights + 1e-9
        query = np.zeros(self.size)
        query[terms] = weights
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        least = 0.0
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] < least:
                break
            own, dense = self.blocks[b]
            found = dense @ query[own]
            ids = np.concatenate([ids, np.arange(self.starts[b], self.starts[b] + len(found))])
            scores = np.concatenate([scores, found])
            order = np.lexsort((ids, -scores))
            ids, scores = ids[order], scores[order]
            enough = np.flatnonzero(np.cumsum(self.n[ids]) >= count)
            if len(enough):
                least = scores[enough[0]] - 1e-12
                keep = scores >= least
                ids, scores = ids[keep], scores[keep]
        near = scores > 0
        return ids[near], scores[near]


@dataclass
class Model:
    vectorizer: Vectorizer
    index: BlockMaxIndex
    rate: float  # share of label 1 among all examples
    raw: np.ndarray  # calibration: rising raw scores
    calibrated: np.ndarray  # and the share of label 1 there

    def votes(self, counts: tuple, without: int | None = None) -> tuple[float, list[tuple[int, float]]]:
        """Share of votes for label 1, and who voted; ``without`` leaves one row of a label out."""
        terms, weights = self.vectorizer.vector(counts)
        ids, scores = self.index.nearest(terms, weights, NEAREST + (without is not None))
        n, bad = self.index.n[ids].copy(), self.index.bad[ids].copy()
        if without is not None and len(ids) and self.index.examples[ids[0]][0] == counts:
            n[0] -= 1
            bad[0] -= without
        # Distance between unit vectors; the weight falls with it and stays finite at 0.
        weight = 1 / (0.05 + np.sqrt(np.maximum(0, 2 - 2 * scores)))
        weight = weight / weight.max() if len(weight) else weight
        total = float((weight * n).sum())
        share = (float((weight * bad).sum()) + PRIOR * self.rate) / (total + PRIOR)
        return share, list(zip(ids.tolist(), scores.tolist()))

    def score(self, counts: tuple) -> tuple[float, list[tuple[int, float]]]:
        share, voters = self.votes(counts)
        return float(np.clip(np.interp(share, self.raw, self.calibrated), 0.0, 1.0)), voters


def _rising(raw: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling neighbours that fall; each pool with one count of doubt."""
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []  # sum of labels, rows, lowest and highest raw score
    for x, y in zip(raw[order].tolist(), label[order].tolist()):
        pools.append([y, 1.0, x, x])
        while len(pools) > 1 and (
            pools[-2][3] == pools[-1][2] or pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]
        ):
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    rate = float(label.mean())
    xs, ys = [], []
    for good, rows, low, high in pools:
        share = (good + rate) / (rows + 1)
        xs += [low, high] if high > low else [low]
        ys += [share, share] if high > low else [share]
    return np.array(xs), np.maximum.accumulate(np.array(ys))


def fit(examples: DataFrame) -> Model:
    """Model from a bounded table (text, label), which must not be empty of labels."""
    examples = stored(examples.where("label is not null"), "examples")
    sums = examples.agg(F.count("*").alias("n"), F.sum("label").alias("bad")).first()
    total, bad = sums["n"], int(sums["bad"] or 0)
    terms = _telling(_term_counts(examples), total, bad, TERMS)
    vectorizer = Vectorizer.of(terms, total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [vectorizer.counts(t) for t in batch.column(0).to_pylist()]
            packed = pa.array([",".join(f"{k}:{n}" for k, n in c) for c in counts], pa.string())
            yield pa.RecordBatch.from_arrays([packed, batch.column(1).cast(pa.int64())], ["counts", "label"])

    rows = (
        examples.select("text", "label")
        .mapInArrow(run, "counts string, label long")
        .groupBy("counts")
        .agg(F.count("*").alias("n"), F.sum("label").alias("bad"))
        .orderBy("counts")
        .collect()
    )
    distinct = [
        (tuple(tuple(map(int, pair.split(":"))) for pair in r["counts"].split(",")), r["n"], r["bad"])
        for r in rows
        if r["counts"]
    ]
    rate = bad / max(1, total)
    model = Model(vectorizer, BlockMaxIndex(vectorizer, distinct), rate, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    raw, label = [], []
    for counts, n, ones in distinct:  # a row of each label, as often as there are such rows
        for y, times in ((1, ones), (0, n - ones)):
            if times:
                raw += [model.votes(counts, without=y)[0]] * times
                label += [y] * times
    if raw:
        model.raw, model.calibrated = _rising(np.array(raw), np.array(label, float))
    return model


def sampled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int = SAMPLE) -> DataFrame:
    """About ``rows`` labelled texts at most, chosen by a hash of the key, as (text, label).

    Their keys are few enough to go to every task, so that the texts of all documents need not move.
    A key with several labels has the largest of them: 1 if any says so.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).alias("known"), F.col(label).cast("int").alias("label")
    )
    total = known.count()
    share = min(1.0, rows / max(1, total))
    chosen = known.where(F.pmod(F.xxhash64("known"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    chosen = stored(chosen.groupBy("known").agg(F.max("label").alias("label")), "chosen")
    return docs.select(F.col(key).alias("known"), F.col(text).alias("text")).join(
        F.broadcast(chosen), "known"
    ).select("text", "label")


def scored(docs: DataFrame, model: Model, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``row`` with the given columns (all by default), ``score`` between 0 and 1, and ``evidence``:
    the nearest kinds of examples as (terms, cosine, examples, toxic).

    Null, empty and wordless texts get the base rate of the examples, calibrated, and no evidence.
    Repeated rows give repeated rows with one score; an empty table gives none; other columns pass
    through in ``row`` and never enter a score.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns or docs.columns]).alias("row"),
        F.col(text).alias("text"),
    )
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kind = (
        T.StructType().add("terms", T.StringType()).add("cosine", T.DoubleType())
        .add("examples", T.LongType()).add("toxic", T.LongType())
    )
    schema = rows.select("row").schema.add("score", T.DoubleType()).add("evidence", T.ArrayType(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = {k: term for term, k in model.vectorizer.number.items()}
        known: dict[tuple, tuple[float, list[dict]]] = {}

        def judged(counts: tuple) -> tuple[float, list[dict]]:
            score, voters = model.score(counts)
            evidence = []
            for k, cosine in voters[:3]:
                example, n, bad = model.index.examples[k]
                terms = ",".join(names[t] for t, _ in example if t != OTHER)
                evidence.append({"terms": terms, "cosine": cosine, "examples": n, "toxic": bad})
            return score, evidence

        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                found = []
                for t in batch.column(1).to_pylist():
                    counts = model.vectorizer.counts(t)
                    if counts not in known:
                        if len(known) > 50_000:
                            known.clear()
                        known[counts] = judged(counts)
                    found.append(known[counts])
                made = [pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], _EVIDENCE)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["row", "score", "evidence"])

    return rows.mapInArrow(run, schema)


_EVIDENCE = pa.list_(
    pa.struct([("terms", pa.string()), ("cosine", pa.float64()), ("examples", pa.int64()), ("toxic", pa.int64())])
)
