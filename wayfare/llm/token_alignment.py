"""Alignment of the tokens of two tokenizers over the same text.

One side is a byte-level BPE of the ``tokenizers`` library (A, reads a space and the text), the other
a BPE of ``sentencepiece`` (B, reads the text and adds the space). Both libraries tell which characters
a token covers. These spans are the coarse cuts: a token that ends between two characters ends at that
byte. Only tokens that share a character (several tokens for one multibyte character on side A, byte
fallback on side B) are placed by the length of their decoded bytes. Byte offsets where tokens of both
sides end cut the two into groups.

Texts are read in units. White space between two visible characters ends a pre-token of A, and no piece
of B goes across it, so both sides tokenize what lies between on its own. A worker aligns every distinct
unit once and keeps the result; a document is the sequence of its units.
"""

from __future__ import annotations

import functools
import gc
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.text import stored

MAX_UNITS = 300_000  # units a worker keeps, about 500 bytes each
CHUNK = 400  # units the libraries read at once
BYTES = 1 << 20  # of text that is worked on at once, or one text
WIDE = 1 << 16  # links of a group above which equal ones are counted, not listed
FREQUENT = 200_000  # rows at most of the table every task gets
MARKS = ".,!?;:"

SPACE = "▁"  # stands for a space in pieces of sentencepiece
_VISIBLE = rf"[^\s᠎{SPACE}]"
_CUT = re.compile(rf"(?<={_VISIBLE})(?=[ \n]{_VISIBLE})")
_CORE = re.compile(rf"{_VISIBLE}(?:.*{_VISIBLE})?", re.DOTALL)
_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_FALLBACK = re.compile("<0x([0-9A-F]{2})>")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: visible Latin-1
    characters for themselves, the others from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + k): b for k, b in enumerate(others)}


class ByteLevelSide:
    """Tokens of a byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, processors

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
        alphabet = byte_alphabet()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes: list[bytes] = [b""] * (1 + max(vocabulary.values()))
        for entry, k in vocabulary.items():
            self.bytes[k] = bytes(alphabet[c] for c in entry)
        with open(path) as file:
            given = json.load(file)
        reader = given["pre_tokenizer"]
        self.newline = vocabulary.get("Ċ")
        self.separable = (
            given["normalizer"] is None
            and reader == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
            and self.newline is not None
        )

    def read(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids, and the first and last character (exclusive) of every token, for each text."""
        for found in self.tokenizer.encode_batch(texts, add_special_tokens=False):
            yield np.array(found.ids, np.int64), _spans(found.offsets)


class PieceSide:
    """Tokens of a ``sentencepiece`` model with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.bytes = [self._bytes(p) if self.model.is_byte(k) else p.replace(SPACE, " ").encode() for k, p in enumerate(pieces)]
        self.prefix = self.model.piece_to_id(SPACE)
        self.newline = pieces.index("<0x0A>") if "<0x0A>" in pieces else None
        self.neighbours = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        self.separable = self.newline is not None and not any(
            pair[1] == SPACE != pair[0] or "\n" in pair for pair in self.neighbours
        )

    @staticmethod
    def _bytes(piece: str) -> bytes:
        return bytes([int(_FALLBACK.fullmatch(piece)[1], 16)])

    def read(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """As for the other side. A text that begins with a space gives that to the model's own
        prefix; before any other text the prefix is a token of its own, which is left out."""
        own = [t[0] == " " for t in texts]
        given = [t[1:] if k else t for t, k in zip(texts, own)]
        for mine, found in zip(own, self.model.encode(given, return_type="offset_mapping", num_threads=1)):
            ids = np.array(found["ids"], np.int64)
            spans = _spans(found["offsets"])
            if mine:
                spans += 1
                spans[:1, 0] = 0
                yield ids, spans
            elif ids[0] == self.prefix and spans[0, 1] == 0:
                yield ids[1:], spans[1:]
            else:
                raise ValueError(f"the prefix is not a token before {texts!r}: {found}")


def _spans(offsets: list[tuple[int, int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(offsets), np.int64, 2 * len(offsets)).reshape(-1, 2)


def byte_ends(ids: np.ndarray, spans: np.ndarray, lengths: np.ndarray, byte_at: np.ndarray) -> np.ndarray:
    """Byte offset at which every token ends.

    A token whose characters are its own ends where its last character ends. One that shares a
    character with the next token, or has none of its own, ends its number of bytes after the last
    token that is placed so.
    """
    following = np.append(spans[1:, 0], spans[-1:, 1])
    sure = (spans[:, 1] > spans[:, 0]) & (following >= spans[:, 1])
    at = np.arange(len(ids))
    last = np.maximum.accumulate(np.where(sure, at, -1))
    ends = byte_at[spans[:, 1]]
    total = np.cumsum(lengths[ids])
    before = np.where(last >= 0, ends[last] - total[last], 0)
    return np.where(sure, ends, before + total)


class Aligner:
    """Aligns units of text and keeps what it found, in arrays over the number of the unit."""

    def __init__(self, path_a: str, path_b: str, most: int = MAX_UNITS):
        self.a, self.b = ByteLevelSide(path_a), PieceSide(path_b)
        self.len_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self.len_b = np.array([len(x) for x in self.b.bytes], np.int64)
        self.most = most
        self.cuts = self.a.separable and self.b.separable
        texts = [[f"{sign}{k}" for k in range(max(len(self.len_a), len(self.len_b)))] for sign in ";,|"]
        self.first, self.later, self.other = (np.array(t, object) for t in texts)
        self.forget()

    def forget(self) -> None:
        self.parts: dict[str, tuple[int, ...]] = {}  # base units, by number, of every unit
        self.number: dict[str, int] = {}  # of base units
        self.units: list[str] = []
        self.groups: list[str] = []  # of each base unit, every group led by a semicolon
        self.wrong: dict[int, tuple[bytes, bytes]] = {}  # base units whose tokens do not give them back
        self.sizes = np.zeros((0, 4), np.int32)  # tokens of A and B, groups, links
        self.ends = np.zeros(1, np.int64)  # of each base unit's links in the next two
        self.links = np.zeros(0, np.int64)
        self.times = np.zeros(0, np.int32)
        self.uses = np.zeros(0, np.int64)
        self.fresh: list[list[np.ndarray]] = []
        if self.cuts:
            self._keep(["\n"], self._alone("\n"))

    # Units

    def pieces(self, text: str) -> list[str]:
        """The units of a space and the text, by key. Where single spaces and line feeds stand alone,
        splitting is enough."""
        if not self.cuts:
            return ["  " + text]
        found = (text.replace("\n", " \n") if "\n" in text else text).split(" ")
        known = self.parts
        if all(_whole(p) for p in set(found) if p not in known):
            return found
        return [_key(unit) for unit in _CUT.split(" " + text)]

    def learn(self, keys: Iterable[str]) -> None:
        """Align the units that are not known yet."""
        recipes, plain, odd = {}, set(), set()
        for key in keys:
            if key not in self.parts:
                recipes[key] = recipe = self._recipe(key)
                (odd if key[0] == " " else plain).update(recipe)
        lines = [unit for unit in plain if unit not in self.number]
        for start in range(0, len(lines), CHUNK):
            self._keep(lines[start : start + CHUNK], self._lines(lines[start : start + CHUNK]))
        for unit in odd:
            if unit not in self.number:
                self._keep([unit], self._alone(unit))
        for key, recipe in recipes.items():
            self.parts[key] = tuple([self.number[u] for u in recipe])

    def _recipe(self, key: str) -> list[str]:
        """Base units that a unit is made of."""
        unit = _unit(key)
        if key[0] == " ":
            return [unit]
        core, parts, lead = unit[1:], [], " "
        if unit[0] == "\n":
            parts, lead = ["\n"], ""
        if core[-1] in MARKS and _WORD.fullmatch(core, 0, len(core) - 1) and core[-2:] not in self.b.neighbours:
            return [*parts, lead + core[:-1], core[-1]]
        return [*parts, lead + core]

    # Alignment

    def _lines(self, units: list[str]) -> tuple:
        """Base units without line feeds, read as the lines of one text."""
        whole = "".join("\n" + u for u in units)
        ids_a, spans_a = next(self.a.read([whole]))
        ids_b, spans_b = next(self.b.read([whole]))
        return self._cut(whole, units, ids_a, spans_a, ids_b, spans_b)

    def _alone(self, unit: str) -> tuple:
        """A unit with white space of other kinds, or a line feed."""
        ids_a, spans_a = next(self.a.read([unit]))
        ids_b, spans_b = next(self.b.read([unit]))
        return self._cut(unit, None, ids_a, spans_a, ids_b, spans_b)

    def _cut(self, whole, units, ids_a, spans_a, ids_b, spans_b) -> tuple:
        """Groups of a text, and what they hold for each line (for the whole without ``units``)."""
        code = whole.encode()
        if len(code) == len(whole):
            byte_at = np.arange(len(whole) + 1)
        else:
            points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
            width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
            byte_at = np.concatenate([[0], np.cumsum(width)])
        ends_a = byte_ends(ids_a, spans_a, self.len_a, byte_at)
        ends_b = byte_ends(ids_b, spans_b, self.len_b, byte_at)
        marks = np.zeros((2, 1 + max(byte_at[-1], ends_a.max(initial=0), ends_b.max(initial=0))), bool)
        marks[0, ends_a] = marks[1, ends_b] = True
        group_of = np.cumsum(marks[0] & marks[1])
        group_of[1:] = group_of[:-1].copy()  # what ends at a common end belongs to the group before it
        group_a, group_b = group_of[ends_a], group_of[ends_b]

        if units is None:
            line_a, line_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
            n, kept_a, kept_b = 1, np.ones(len(ids_a), bool), np.ones(len(ids_b), bool)
            units = [whole]
        else:
            kept_a, kept_b = ids_a != self.a.newline, ids_b != self.b.newline
            line_a, line_b = np.cumsum(~kept_a) - 1, np.cumsum(~kept_b) - 1
            n = len(units)
            if line_a[-1] != n - 1 or line_b[-1] != n - 1:
                raise ValueError("a line feed is not a token of its own")
        ids_a, group_a, line_a = ids_a[kept_a], group_a[kept_a], line_a[kept_a]
        ids_b, group_b, line_b = ids_b[kept_b], group_b[kept_b], line_b[kept_b]

        wrong = self._given_back(units, ids_a, line_a, ids_b, line_b)
        # Numbers of the groups without gaps; both sides have a token in each, unless a unit is wrong.
        held = np.zeros(group_of[-1] + 1, bool)
        held[group_a] = held[group_b] = True
        place, n_groups = np.cumsum(held) - 1, int(held.sum())
        group_a, group_b = place[group_a], place[group_b]
        n_a, n_b = (np.bincount(g, minlength=n_groups) for g in (group_a, group_b))
        line = np.zeros(n_groups, np.int64)
        line[group_a], line[group_b] = line_a, line_b

        texts_a = np.where(np.diff(group_a, prepend=-1) > 0, self.first[ids_a], self.later[ids_a])
        texts_b = np.where(np.diff(group_b, prepend=-1) > 0, self.other[ids_b], self.later[ids_b])
        place = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        texts = np.concatenate([texts_a, texts_b])[place].tolist()
        text_end = np.cumsum(np.bincount(line_a, minlength=n) + np.bincount(line_b, minlength=n)).tolist()
        groups = ["".join(texts[x:y]) for x, y in zip([0, *text_end], text_end)]

        link_line, link, times = self._links(ids_a, ids_b, n_a, n_b, line)
        sums = [np.bincount(line_a, minlength=n), np.bincount(line_b, minlength=n), np.bincount(line, minlength=n)]
        sums.append(np.bincount(line, n_a * n_b, minlength=n))
        sizes = np.stack(sums, axis=1).astype(np.int32)
        return groups, sizes, np.bincount(link_line, minlength=n), link, times.astype(np.int32), wrong

    def _given_back(self, units, ids_a, line_a, ids_b, line_b) -> dict[int, tuple[bytes, bytes]]:
        """Joined bytes of both sides, for the units that they differ from."""
        sides = [
            (list(map(self.a.bytes.__getitem__, ids_a.tolist())), line_a),
            (list(map(self.b.bytes.__getitem__, ids_b.tolist())), line_b),
        ]
        code = "".join(units).encode()
        if all(b"".join(tokens) == code for tokens, _ in sides):
            return {}
        joined = []
        for tokens, line in sides:
            ends = np.searchsorted(line, np.arange(len(units)), "right")
            joined.append([b"".join(tokens[s:e]) for s, e in zip([0, *ends[:-1]], ends)])
        return {k: pair for k, (u, *pair) in enumerate(zip(units, *joined)) if set(pair) != {u.encode()}}

    def _links(self, ids_a, ids_b, n_a, n_b, line) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, link, how often) of all pairs of tokens in one group, in the order of lines."""
        size, wide = n_a * n_b, n_a * n_b > WIDE
        start_a, start_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        some = np.where(wide, 0, size)
        group = np.repeat(np.arange(len(size)), some)
        k = np.arange(len(group)) - np.repeat(np.cumsum(some) - some, some)
        a = ids_a[start_a[group] + k // np.maximum(n_b[group], 1)]
        b = ids_b[start_b[group] + k % np.maximum(n_b[group], 1)]
        lines, links, times = [line[group]], [a * len(self.len_b) + b], [np.ones(len(group), np.int64)]
        for g in np.flatnonzero(wide):
            own_a, times_a = np.unique(ids_a[start_a[g] : start_a[g] + n_a[g]], return_counts=True)
            own_b, times_b = np.unique(ids_b[start_b[g] : start_b[g] + n_b[g]], return_counts=True)
            links.append((own_a[:, None] * len(self.len_b) + own_b).ravel())
            times.append((times_a[:, None] * times_b).ravel())
            lines.append(np.full(len(links[-1]), line[g]))
        if len(lines) == 1:
            return lines[0], links[0], times[0]
        lines, links, times = (np.concatenate(x) for x in (lines, links, times))
        order = np.argsort(lines, kind="stable")
        return lines[order], links[order], times[order]

    def _keep(self, units: list[str], found: tuple) -> None:
        base = len(self.units)
        groups, *arrays, wrong = found
        self.units += units
        self.groups += groups
        self.number.update(zip(units, range(base, base + len(units))))
        self.wrong.update({base + k: pair for k, pair in wrong.items()})
        self.fresh.append(arrays)

    def _settle(self) -> None:
        """Put what was learned at the end of the arrays."""
        if self.fresh:
            sizes, lengths, links, times = (np.concatenate(x) for x in zip(*self.fresh))
            self.sizes = np.concatenate([self.sizes, sizes])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])
            self.links = np.concatenate([self.links, links])
            self.times = np.concatenate([self.times, times])
            self.uses = np.concatenate([self.uses, np.zeros(len(sizes), np.int64)])
            self.fresh = []

    def _shrink(self) -> None:
        """Keep the base units that were used twice at least, or the more frequent half of the limit.
        Most words occur once; the others are not read again."""
        kept = self.uses >= 2
        if kept.sum() > self.most // 2:
            kept = self.uses > np.sort(self.uses)[-(self.most // 2)]
        if self.cuts:
            kept[self.number["\n"]] = True
        renumbered = np.where(kept, np.cumsum(kept) - 1, -1).tolist()
        rows = np.repeat(kept, np.diff(self.ends))
        lengths = np.diff(self.ends)[kept]
        self.sizes, self.uses = self.sizes[kept], self.uses[kept] // 2
        self.links, self.times = self.links[rows], self.times[rows]
        self.ends = np.concatenate([[0], np.cumsum(lengths)])
        self.units = [u for u, k in zip(self.units, renumbered) if k >= 0]
        self.groups = [g for g, k in zip(self.groups, renumbered) if k >= 0]
        self.number = {u: k for k, u in enumerate(self.units)}
        self.wrong = {renumbered[k]: pair for k, pair in self.wrong.items() if renumbered[k] >= 0}
        parts = ((key, tuple([renumbered[x] for x in own])) for key, own in self.parts.items())
        self.parts = {key: own for key, own in parts if min(own) >= 0}
        if len(self.parts) > self.most // 2:
            self.parts = {}  # quickly put together again

    # Documents

    def documents(self, texts: list[str | None]) -> dict[str, object]:
        """Columns of the result for some texts."""
        if len(self.parts) > self.most:
            self._shrink()
        pieces = [self.pieces(t) if t else [] for t in texts]
        self.learn(set().union(*pieces))
        self._settle()
        parts = self.parts
        numbers = [[x for p in own for x in parts[p]] for own in pieces]
        lengths = np.array([len(own) for own in numbers], np.int64)
        if self.wrong:
            for k, own in enumerate(numbers):
                if not self.wrong.keys().isdisjoint(own) and not self._whole_text(texts[k], own):
                    numbers[k], lengths[k] = [], 0
        document = np.repeat(np.arange(len(texts)), lengths)
        units = np.fromiter(chain.from_iterable(numbers), np.int64, int(lengths.sum()))
        self.uses += np.bincount(units, minlength=len(self.units))
        sizes = np.zeros((len(texts), 4), np.int64)
        for column in range(4):
            sizes[:, column] = np.bincount(document, self.sizes[units, column], len(texts))
        owner, link, times = self._document_links(document, units, len(texts))
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])
        pairs = pa.StructArray.from_arrays(
            [pa.array(x.astype(np.int32)) for x in (*np.divmod(link, len(self.len_b)), times)], ["a", "b", "n"]
        )
        return {
            "groups": pa.array(["".join(map(self.groups.__getitem__, own))[1:] for own in numbers], pa.string()),
            **{name: pa.array(sizes[:, k]) for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
            "links": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pairs),
        }

    def _whole_text(self, text: str, units: list[int]) -> bool:
        """Whether the tokens of all units together give back a space and the text."""
        whole = (" " + text).encode()
        joined = [
            b"".join(self.wrong[x][side] if x in self.wrong else self.units[x].encode() for x in units) for side in (0, 1)
        ]
        return joined == [whole, whole]

    def _document_links(self, document, units, n) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, link, how often) without repeats, by document and link."""
        keys, often = np.unique(document * len(self.groups) + units, return_counts=True)
        document, units = np.divmod(keys, max(1, len(self.groups)))
        length = self.ends[units + 1] - self.ends[units]
        row = np.repeat(np.arange(len(units)), length)
        at = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length) + self.ends[units][row]
        times = self.times[at] * often[row]
        span = len(self.len_a) * len(self.len_b)
        keys = document[row] * span + self.links[at]
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        document, link = np.divmod(keys[first], span)
        return document, link, np.add.reduceat(times, first) if len(first) else times[:0]


def _unit(key: str) -> str:
    return key[1:] if key[0] == " " else key if key[0] == "\n" else " " + key


def _key(unit: str) -> str:
    """A unit that splitting could give goes by what splitting would call it, which never begins with a
    space; any other has a space before it."""
    core = unit[1:]
    if _whole(core) and " " not in core and "\n" not in core:
        return core if unit[0] == " " else unit
    return " " + unit


def _whole(piece: str) -> bool:
    """Whether what stands between two cuts neither begins nor ends with white space."""
    return bool(_CORE.fullmatch(piece, 1 if piece[:1] == "\n" else 0))


@functools.lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str, most: int) -> Aligner:
    """One for a worker process, which serves many tasks."""
    return Aligner(path_a, path_b, most)


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


def align(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    text: str = "text",
    columns: list[str] | None = None,
    most_units: int = MAX_UNITS,
) -> DataFrame:
    """``row`` with the given columns (all by default) and the aligned tokens of its text: ``groups``
    (``a1,a2|b1;a3|b2,b3``: ids of A and B in order), ``n_a``, ``n_b``, ``n_groups``, ``n_links``, and
    ``links``: every pair of ids (a, b) that shares a group, with how often (n), by a and b.

    The files have to be readable on every executor. Null and empty texts, and texts that the joined
    bytes of A or B do not give back (B takes U+2581 for a space), have no tokens: zeros, no groups and
    no links. Repeated rows give repeated rows, an empty table none; other columns pass through in
    ``row``. Texts are read whole, however long: memory goes with the longest text and the distinct
    words that a worker keeps (``most_units``). In a group with many tokens on both sides equal links
    are counted, not listed.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns or docs.columns]).alias("row"),
        F.col(text).alias("text"),
    )
    link = T.StructType().add("a", "integer").add("b", "integer").add("n", "integer")
    schema = rows.select("row").schema.add("groups", "string")
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        schema = schema.add(name, "long")
    schema = schema.add("links", T.ArrayType(link))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b, most_units)
        for whole in batches:
            for batch in _slices(whole, 1):
                gc.disable()  # what is kept has no cycles
                found = aligner.documents(batch.column(1).to_pylist())
                gc.enable()
                yield pa.RecordBatch.from_arrays([batch.column(0), *found.values()], schema.names)

    return rows.mapInArrow(run, schema)


def link_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, documents, best): in how many rows of ``aligned`` a pair of ids is linked, and whether no
    other partner of ``a`` is in more (ties are all best)."""
    counts = aligned.select(F.inline("links")).groupBy("a", "b").agg(F.count("*").alias("documents"))
    highest = F.max("documents").over(Window.partitionBy("a"))  # as many rows as B has tokens, at most
    return counts.withColumn("best", F.col("documents") == highest)


def frequent(counts: DataFrame, rows: int = FREQUENT) -> DataFrame:
    """The pairs in most documents, ``rows`` at most: those above a number found from a histogram with
    eight bins to a doubling, of which a few hundred rows come to the driver."""
    step = F.floor(F.log2(F.col("documents").cast("double")) * 8)
    lowest, total = None, 0
    for b in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        total += b["count"]
        if total > rows:
            break
        lowest = b["step"]
    return counts.where(step >= F.lit(lowest)) if lowest is not None else counts.where("false")


def counted(aligned: DataFrame, rows: int = FREQUENT) -> DataFrame:
    """``aligned`` without its links, with ``n_best``, the links whose pair is the most frequent of its
    A id (ties included), and ``count_sum``, the number of rows that hold the pair, summed over the links.

    Frequent pairs (``rows`` at most) meet the links in the tasks that read them, the others in a
    shuffle in which no pair is frequent. Rows without links get zeros; repeated rows count each.
    """
    # The numbers of the rows are written with them, so a task that is run again finds the same.
    kept = stored(aligned.withColumn("at", F.monotonically_increasing_id()), "aligned-tokens")
    counts = stored(link_counts(kept), "link-counts")
    common = F.broadcast(frequent(counts, rows))
    links = kept.select("at", F.inline("links"))
    total = [
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("documents")).alias("count_sum"),
    ]
    near = links.join(common, ["a", "b"]).groupBy("at").agg(*total)
    rare = links.join(common, ["a", "b"], "left_anti").join(counts, ["a", "b"]).groupBy("at").agg(*total)
    names = ("n_best", "count_sum")
    sums = near.unionByName(rare).groupBy("at").agg(*[F.sum(c).alias(c) for c in names])
    return kept.join(sums, "at", "left").select(
        *[F.col(f"`{c}`") for c in aligned.columns if c != "links"],
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names],
    )
