"""Language of a text by rank-order profiles.

A language's profile is the list of its most frequent n-grams of letters, by rank. A document's most
frequent n-grams are ranked likewise; every n-gram is out of place by the difference of its two ranks, or
by the length of a profile if the language does not have it. The language with the least sum is taken.

Profiles are fitted on a sample of bounded size from each language; tasks add up what they read before
the shuffle, so a language that holds most of the documents is a few rows for each task there. Documents are worked on in batches,
as arrays of code points; an n-gram is one number.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACES = 300  # n-grams of a profile
SAMPLE = 20_000  # labelled texts of each language that a model is fitted on, at most about so many
LONGEST = 3  # letters of an n-gram; three code points of 21 bits fit into a number of 63
MOST_LANGUAGES = 5_000  # that a model may have: its profiles are sent to every task
BYTES = 1 << 20  # of text that is worked on at once, or one text
HELD = 1_000_000  # n-grams that a task holds before it hands them on
UNDETERMINED = "und"


@functools.cache
def _is_letter() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@functools.cache
def _is_mark() -> np.ndarray:
    """Combining marks belong to the word that they stand in."""
    import unicodedata

    return np.fromiter((unicodedata.category(chr(c))[0] == "M" for c in range(0x110000)), bool, 0x110000)


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, n-gram, how often) of some texts, each n-gram of a document once.

    Texts are in lower case; words are runs of letters, with the combining marks in them, and an n-gram
    may reach one place beyond either end of a word. A text without a letter has none.
    """
    lower = [t.lower() if t else "" for t in texts]
    lengths = np.array([len(t) for t in lower], np.int64) + 2
    # A blank on either side of every text, so that no n-gram is in two texts.
    points = np.frombuffer("".join(f" {t} " for t in lower).encode("utf-32-le"), np.uint32).astype(np.int64)
    document = np.repeat(np.arange(len(texts)), lengths)
    letter = _is_letter()[points]
    lettered = np.zeros(len(texts), bool)
    lettered[document[letter]] = True
    inside = (letter | _is_mark()[points]) & lettered[document]
    points = np.where(inside, points, ord(" "))
    # Only the blanks beside words are needed.
    kept = inside.copy()
    kept[1:] |= inside[:-1]
    kept[:-1] |= inside[1:]
    points, document, inside = points[kept], document[kept], inside[kept]
    # Letters by their place among those that occur, so that a document and an n-gram are one number.
    seen = np.zeros(0x110000, np.int64)
    seen[points] = 1
    alphabet = np.flatnonzero(seen)
    letters = (np.cumsum(seen) - 1)[points]
    base = len(alphabet)
    found = []
    code, some = np.zeros(len(points), np.int64), np.zeros(len(points), bool)
    for n in range(1, LONGEST + 1):
        size = len(points) - n + 1
        if size <= 0:
            break
        code = code[:size] * base + letters[n - 1 :]
        some = some[:size] | inside[n - 1 :]
        own = some & (document[:size] == document[n - 1 :])
        if n == 1:
            own &= inside
        if n == 3:  # a blank in the middle would join two words
            own &= inside[1 : size + 1]
        keys = np.sort(document[:size][own] * base**n + code[own])
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        owner, dense = np.divmod(keys[first], base**n)
        packed = np.zeros(len(dense), np.int64)
        for place in reversed(range(n)):
            packed = (packed << 21) | alphabet[dense // base**place % base]
        found.append((owner, packed, np.diff(np.append(first, len(keys)))))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(column) for column in zip(*found))


def ranked(document: np.ndarray, code: np.ndarray, count: np.ndarray, places: int) -> tuple[np.ndarray, ...]:
    """(document, n-gram, place) of the most frequent n-grams of each document; equally frequent ones
    go by number."""
    order = np.lexsort((code, -count, document))
    document, code = document[order], code[order]
    start = np.flatnonzero(np.diff(document, prepend=-1))
    place = np.arange(len(document)) - np.repeat(start, np.diff(np.append(start, len(document))))
    top = place < places
    return document[top], code[top], place[top]


@dataclass
class Profiles:
    """Languages in the order of their names; the n-grams that any of them has, with their places."""

    languages: list[str]
    codes: np.ndarray
    places: np.ndarray  # by n-gram and language; ``length`` where a language does not have it
    length: int

    @classmethod
    def of(cls, rows: list[tuple[str, int, int]], length: int = PLACES) -> Profiles:
        """From (language, n-gram, place)."""
        languages = sorted({r[0] for r in rows})
        codes = np.unique(np.array([r[1] for r in rows], np.int64))
        places = np.full((len(codes), len(languages)), length, np.int32)
        at = {name: k for k, name in enumerate(languages)}
        for name, code, place in rows:
            places[np.searchsorted(codes, code), at[name]] = place
        return cls(languages, codes, places, length)

    def distances(self, document: np.ndarray, code: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
        """Sum over the n-grams of each of ``n`` documents of how far they are out of place."""
        sums = np.zeros((n, len(self.languages)), np.int64)
        if not len(code):
            return sums
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        known = self.codes[at] == code
        theirs = np.where(known[:, None], self.places[at], self.length)
        out = np.where(theirs < self.length, np.abs(theirs - place[:, None]), self.length)
        start = np.flatnonzero(np.diff(document, prepend=-1))
        sums[document[start]] = np.add.reduceat(out, start, axis=0, dtype=np.int64)
        return sums

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        found = ranked(*ngrams(texts), self.length)
        n_grams = np.bincount(found[0], minlength=len(texts))
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        sums = self.distances(*found, len(texts))
        best = np.argmin(sums, axis=1)
        least = sums[np.arange(len(texts)), best]
        score = 1 - least / np.maximum(n_grams * self.length, 1)
        names = [self.languages[k] if n else UNDETERMINED for k, n in zip(best, n_grams)]
        return names, np.where(n_grams > 0, score, 0.0)


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices with about ``BYTES`` of text; one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = total[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(total, before + BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def counts(sample: DataFrame) -> DataFrame:
    """(language, code, n): how often each n-gram occurs, from (language, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def summed(language: str) -> tuple[np.ndarray, np.ndarray]:
            codes = np.concatenate([c for c, _ in held[language]])
            numbers = np.concatenate([n for _, n in held[language]])
            known, at = np.unique(codes, return_inverse=True)
            return known, np.bincount(at, numbers, len(known)).astype(np.int64)

        def hand_on() -> Iterator[pa.RecordBatch]:
            for language in held:
                codes, numbers = summed(language)
                names = pa.DictionaryArray.from_arrays(np.zeros(len(codes), np.int32), [language]).cast(pa.string())
                arrays = [names, pa.array(codes), pa.array(numbers)]
                yield pa.RecordBatch.from_arrays(arrays, ["language", "code", "n"])
            held.clear()

        size = 0
        for whole in batches:
            for batch in _slices(whole, 1):
                labels = batch.column(0).to_pylist()
                names = sorted(set(labels))
                at = {name: k for k, name in enumerate(names)}
                document, code, count = ngrams(batch.column(1).to_pylist())
                language = np.array([at[name] for name in labels], np.int64)[document]
                for k, name in enumerate(names):
                    own = language == k
                    if own.any():
                        held.setdefault(name, []).append((code[own], count[own]))
                        size += int(own.sum())
                if size > HELD:  # of the same n-grams, mostly
                    held = {name: [summed(name)] for name in held}
                    size = sum(len(own[0][0]) for own in held.values())
                    if size > HELD // 2:
                        yield from hand_on()
                        size = 0
        yield from hand_on()

    found = sample.mapInArrow(run, "language string, code long, n long")
    return found.groupBy("language", "code").agg(F.sum("n").alias("n"))


def sampled(labelled: DataFrame, text: str, label: str, rows: int) -> DataFrame:
    """(label, text) of about ``rows`` texts of each language at most, chosen by a hash of the text;
    all texts of languages with fewer. More than ``MOST_LANGUAGES`` languages are an error."""
    known = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    sizes = known.groupBy(F.col(label).cast("string").alias("language")).count().limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: is {label} a language?")
    large = {r.language: int((1 << 30) * rows / r["count"]) for r in sizes if r["count"] > rows}
    chosen = known.select(F.col(label).cast("string").alias("language"), F.col(text).alias("text"))
    if not large:
        return chosen
    share = F.create_map(*[F.lit(x) for pair in large.items() for x in pair])[F.col("language")]
    return chosen.where(share.isNull() | (F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share))


def fit(
    labelled: DataFrame, text: str = "text", label: str = "lang", places: int = PLACES, rows: int = SAMPLE
) -> Profiles:
    """Profiles of all languages of ``label``, from about ``rows`` texts of each at most. ``places`` rows
    for each language come to the driver.

    Rows without a text or a label are left out; repeated rows count each; an empty table gives a model
    that calls every text undetermined. Equally frequent n-grams go by code point.
    """
    order = Window.partitionBy("language").orderBy(F.desc("n"), "code")
    summed = counts(sampled(labelled, text, label, rows))
    top = summed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= places)
    return Profiles.of([(r.language, r.code, r.place - 1) for r in top.collect()], places)


def identified(docs: DataFrame, profiles: Profiles, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``row`` with the given columns (all by default), ``language`` and ``score`` of its text.

    The score is 1 where all n-grams are in place and 0 where none is known. Null texts and texts
    without a letter are ``und`` with score 0; languages that are equally far go by name. Texts count
    whole, however long. Repeated rows give repeated rows, an empty table none; other columns pass
    through in ``row`` and never enter a result.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns or docs.columns]).alias("row"), F.col(text).alias("text")
    )
    schema = rows.select("row").schema.add("language", T.StringType()).add("score", T.DoubleType())
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, 1):
                names, score = shared.value.predict(batch.column(1).to_pylist())
                arrays = [batch.column(0), pa.array(names, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return rows.mapInArrow(run, schema)
