"""Byte-level BPE as a transducer: encode by states, decode by states.

Reading a pre-token byte by byte, the encoding of the whole is not known before its end, but it
is always the encoding of some prefix followed by one token that is still growing. A state of the
transducer is the set of these possibilities: for each live prefix, the tokens not yet written and
the part of a token read since. What all possibilities begin with is written at once, so the
lookahead is bounded by the longest token. States and moves are made when first needed (lazy
determinisation) and kept.

That two tokens may stand side by side depends on these two alone: they may exactly if merging
their joined bytes by rank gives the two back. This is what compiles the merge ranks into moves.
"""

from __future__ import annotations

import base64
import functools
import gc
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_STATES = 220_000  # states are dropped beyond this number and made anew
MAX_EDGES = 16_000  # tokens taken apart, kept likewise
MAX_SIDE = 200_000  # pairs of neighbours, likewise
MAX_KNOWN = 500_000  # units kept: the first, and so the common ones; others are read again
MAX_KNOWN_CHARS = 64  # longer ones are not kept
MARKS = ".,;:!?"
ODD = b"?"  # stands for the tokens of a unit that cannot be told alone
SAME_LETTERS = "\u0500"  # below, str.isalpha and the pattern agree on what a letter is
NEVER = 1 << 62  # above every rank
BYTES = 4 << 20  # bytes of the texts handled at once
TOKENS = 1 << 19  # tokens decoded at once


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merge_by_rank(piece: bytes, ranks: dict[bytes, int], stop: int = 1) -> list[bytes]:
    """The definition: merge the neighbours of lowest rank, leftmost first, while there are any."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > stop:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
        if rank == NEVER:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """Encodes one pre-token at a time; feed it bytes, it writes tokens."""

    def __init__(self, ranks: dict[bytes, int], most_states: int | None = None):
        self.most_states = most_states or MAX_STATES
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        # The begun tokens: next node by node and byte; node 0 is the empty part. A node that
        # ends a token has its rank in ``ends``, one that no token goes beyond is in ``leaves``.
        self.next: dict[int, int] = {}
        self.ends: list[int | None] = [None]
        inner = {0}
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                inner.add(node)
                node = self.next.setdefault(node << 8 | byte, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(None)
            self.ends[node] = rank
        self.leaves = frozenset(range(len(self.ends))) - inner
        self.alone = {rank: (rank,) for rank in self.tokens}
        self._edges: dict[bytes, tuple[list, list] | None] = {}
        self._reset()

    def _reset(self) -> None:
        # A state: the last token written, the parts, and what waits in front of each.
        start = (None, (0,), ((),))
        self.states = [start]
        self.number = {start: 0}
        # By state and byte: the next state, or its complement where the move writes tokens.
        self.moves: dict[int, int] = {}
        self.writes: dict[int, tuple[int, ...]] = {}
        self._side: dict[int, bool] = {}

    def edges(self, token: bytes) -> tuple[list, list] | None:
        """What stands at the left and at the right edge of a token while it is merged.

        Two lists of (part, rank of the merge that absorbs it), from the single byte to the
        token itself. None for a token that merging its bytes does not give.
        """
        if token not in self._edges:
            if len(self._edges) > MAX_EDGES:
                self._edges.clear()
            found: tuple[list, list] | None = ([(token, NEVER)], [(token, NEVER)])
            if len(token) > 1:
                parts = merge_by_rank(token, self.ranks, stop=2)
                whole = len(parts) == 2 and (self.edges(parts[0]), self.edges(parts[1]))
                if whole and None not in whole:
                    rank = self.ranks[token]
                    for side, own in zip(found, (whole[0][0], whole[1][1])):
                        side[:0] = [*own[:-1], (own[-1][0], rank)]
                else:
                    found = None
            self._edges[token] = found
            return found
        return self._edges[token]

    def side_by_side(self, left: int | None, right: int) -> bool:
        """Whether ``right`` may follow ``left``, or open a pre-token if there is none.

        Merging replayed at their border: in the order of ranks, whichever comes first of a merge
        inside the left token, one inside the right token, and one across the border, which
        would part them. Of equal ranks the leftmost goes first.
        """
        key = right if left is None else left + 1 << 32 | right
        if key not in self._side:
            if len(self._side) > MAX_SIDE:
                self._side.clear()
            after = self.edges(self.tokens[right])
            before = self.edges(self.tokens[left]) if left is not None else ((), ())
            ok = after is not None and before is not None
            if ok and left is not None:
                tails, heads = before[1], after[0]
                i = j = 0
                while True:
                    (tail, left_rank), (head, right_rank) = tails[i], heads[j]
                    across = self.ranks.get(tail + head, NEVER)
                    if across < left_rank and across <= right_rank:
                        ok = across == NEVER
                        break
                    if left_rank == right_rank == NEVER:
                        break
                    if left_rank <= right_rank:
                        i += 1
                    else:
                        j += 1
            self._side[key] = ok
        return self._side[key]

    def _move(self, state: int, byte: int) -> int:
        last, parts, waits = self.states[state]
        step, ends, leaves, alone, side = self.next.get, self.ends, self.leaves, self.alone, self._side
        nodes: list[int] = []
        paths: list[tuple[int, ...]] = []
        whole = None
        for node, waiting in zip(parts, waits):
            node = step(node << 8 | byte)
            if node is None:
                continue
            token = ends[node]
            if token is not None and whole is None:
                left = waiting[-1] if waiting else last
                fits = side.get(token if left is None else left + 1 << 32 | token)
                if self.side_by_side(left, token) if fits is None else fits:
                    whole = waiting + alone[token] if waiting else alone[token]
            if node not in leaves:
                nodes.append(node)
                paths.append(waiting)
        # The order is that of the lengths of the parts; the prefix read as a whole comes last.
        nodes.append(0)
        paths.append(whole)
        first = paths[0]
        shared = 0
        for k, token in enumerate(first):
            if any(len(waiting) <= k or waiting[k] != token for waiting in paths):
                break
            shared = k + 1
        written = first[:shared]
        if shared:
            paths = [
                alone[waiting[shared]] if len(waiting) == shared + 1 else waiting[shared:]
                for waiting in paths
            ]
            last = written[-1]
        if all(paths):
            last = None  # it matters only to a path that has nothing waiting
        key = (last, tuple(nodes), tuple(paths))
        target = self.number.setdefault(key, len(self.states))
        if target == len(self.states):
            self.states.append(key)
        if written:
            self.writes[state << 8 | byte] = written
            target = ~target
        self.moves[state << 8 | byte] = target
        return target

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:  # a pre-token that is a token stands for itself
            return [whole]
        if len(self.states) > self.most_states:
            self._reset()
        out: list[int] = []
        state, known = 0, self.moves.get
        for byte in piece[:-1]:
            at = state << 8 | byte
            state = known(at)
            if state is None:
                state = self._move(at >> 8, byte)
            if state < 0:
                out += self.writes[at]
                state = ~state
        if piece:
            out += self._finish(state, piece[-1])
        return out

    def _finish(self, state: int, byte: int) -> tuple[int, ...]:
        """What the last byte writes: only the path that ends with it matters, not a new state."""
        last, parts, waits = self.states[state]
        step, ends, side = self.next.get, self.ends, self._side
        for node, waiting in zip(parts, waits):
            node = step(node << 8 | byte)
            token = ends[node] if node is not None else None
            if token is not None:
                left = waiting[-1] if waiting else last
                fits = side.get(token if left is None else left + 1 << 32 | token)
                if self.side_by_side(left, token) if fits is None else fits:
                    return waiting + self.alone[token]
        raise AssertionError("every prefix has an encoding")


class Encoder:
    """Encodes texts; what repeats from text to text goes through the transducer once.

    A unit is one blank and the run up to the next blank. Where no such run of a text is empty or
    begins or ends with white space, no pre-token crosses their borders, so the tokens of a unit do
    not depend on what is around. Other texts are cut by the pattern as a whole.
    """

    def __init__(
        self,
        ranks: dict[bytes, int],
        pattern: str,
        most_known: int | None = None,
        most_states: int | None = None,
    ):
        self.most_known = most_known or MAX_KNOWN
        self.transducer = Transducer(ranks, most_states)
        self.pieces = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self._mark = {m: array("i", self.transducer.encode(m.encode())).tobytes() for m in MARKS}

    def _piece(self, piece: str) -> bytes:
        return array("i", self.transducer.encode(piece.encode())).tobytes()

    def whole(self, text: str) -> bytes:
        """Token ids of a text, as 32-bit integers."""
        return b"".join(map(self._piece, self.pieces(text)))

    def _new(self, unit: str) -> bytes:
        """Token ids of a blank and a unit; ``ODD`` if they depend on what is around.

        Letters are one pre-token, a mark behind them another.
        """
        if not unit or unit[0].isspace() or unit[-1].isspace():
            ids = ODD
        elif unit.isalpha() and (unit.isascii() or max(unit) < SAME_LETTERS):
            ids = self._piece(" " + unit)
        elif unit[-1] in self._mark and unit[:-1].isalpha() and (unit.isascii() or max(unit) < SAME_LETTERS):
            body = unit[:-1]
            ids = (self.known.get(body) or self._piece(" " + body)) + self._mark[unit[-1]]
        else:
            ids = self.whole(" " + unit)
        if len(self.known) < self.most_known and len(unit) <= MAX_KNOWN_CHARS:
            self.known[unit] = ids
        return ids

    def units(self, units: list[str]) -> list[bytes]:
        return [ids or self._new(unit) for unit, ids in zip(units, map(self.known.get, units))]

    def batch(self, texts: pa.StringArray, machine: Utf8Machine | None = None) -> tuple[pa.ListArray, list[str] | None]:
        """Token ids of many texts, and with a machine what they decode to; null texts have none.

        Distinct units are found for all texts at once, and their ids dealt out again. A unit is made
        of whole characters, so its ids are decoded once as well.
        """
        texts = texts.fill_null("")
        split = pc.split_pattern(texts, " ")
        at = split.offsets.to_numpy() - split.offsets[0].as_py()
        firsts, count = at[:-1], len(texts)
        units = split.flatten()
        coded = units.dictionary_encode()
        codes = coded.indices.to_numpy()
        # In order, so that units with a common beginning meet states just used.
        order = pc.array_sort_indices(coded.dictionary)
        ids = self.units(coded.dictionary.take(order).to_pylist())
        place = np.empty(len(ids), np.int32)
        place[order.to_numpy()] = np.arange(len(ids), dtype=np.int32)
        codes = place[codes]
        distinct = len(ids)
        # The first run of a text has no blank in front; texts with odd runs are done as a whole.
        odd = np.array([x is ODD for x in ids] + [False], bool)
        rest = codes.copy()
        rest[firsts] = distinct
        is_odd = np.logical_or.reduceat(odd[rest], firsts) if count else np.zeros(0, bool)
        heads = units.take(pa.array(firsts)).to_pylist()
        spaced = [h[-1:].isspace() for h in heads]
        codes[firsts] = distinct + np.arange(count)
        for k, head in enumerate(heads):
            if is_odd[k] or spaced[k]:
                codes[at[k] + 1 : at[k + 1]] = distinct + count
                head = texts[k].as_py()
            ids.append(self.whole(head))
        pool = [b"" if x is ODD else x for x in ids] + [b""]
        sizes = np.array([len(x) // 4 for x in pool], np.int32)
        flat = np.frombuffer(b"".join(pool), np.int32)
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[codes]
        ends = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
        where = np.arange(ends[-1], dtype=np.int32)
        where += np.repeat((starts[codes] - ends[:-1]).astype(np.int32), lengths)
        found = pa.ListArray.from_arrays(pa.array(ends[at].astype(np.int32)), pa.array(flat[where]))
        if machine is None:
            return found, None
        runs, dealt = machine.runs(flat.tolist(), np.cumsum(sizes).tolist()), codes.tolist()
        return found, ["".join([runs[c] for c in dealt[s:e]]) for s, e in zip(at.tolist(), at[1:].tolist())]


# Number of bytes of a character by its first byte, and the range of its second byte where that
# is narrower than 80-BF. Fixed values of the UTF-8 definition.
_SECOND = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}


def _length(lead: int) -> int:
    if lead < 0x80:
        return 1
    if 0xC2 <= lead <= 0xDF:
        return 2
    if 0xE0 <= lead <= 0xEF:
        return 3
    return 4 if 0xF0 <= lead <= 0xF4 else 0


class Utf8Machine:
    """Incremental decoder over tokens. A state is the begun character: none, or 1 to 3 bytes.

    The move of a state under a token gives the next state and the characters completed; moves
    are made when first needed. Bytes that cannot continue a character become U+FFFD.
    """

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        self.moves: dict[bytes, dict[int, tuple[bytes, str]]] = {}
        self.plain: dict[int, str] = {}  # tokens made of whole characters

    def runs(self, ids: list[int], ends: list[int]) -> list[str]:
        """Texts of many runs of tokens, each from the empty state."""
        if not self.plain:
            for token, data in self.tokens.items():
                state, text = self.push(b"", data)
                if not state:
                    self.plain[token] = text
        texts, found, start = list(map(self.plain.get, ids)), [], 0
        for end in ends:
            try:
                found.append("".join(texts[start:end]))
            except TypeError:  # a token with a part of a character
                found.append("".join(self.stream(ids[start:end])))
            start = end
        return found

    @staticmethod
    def push(state: bytes, data: bytes) -> tuple[bytes, str]:
        out: list[str] = []
        for k in range(len(data)):
            byte = data[k]
            if state:
                low, high = _SECOND.get(state[0], (0x80, 0xBF)) if len(state) == 1 else (0x80, 0xBF)
                if low <= byte <= high:
                    state += data[k : k + 1]
                    if len(state) == _length(state[0]):
                        out.append(state.decode())
                        state = b""
                    continue
                out.append("�")
                state = b""
            size = _length(byte)
            if size == 1:
                out.append(chr(byte))
            elif size:
                state = data[k : k + 1]
            else:
                out.append("�")
        return state, "".join(out)

    def stream(self, ids: list[int]) -> Iterator[str]:
        state = b""
        for token in ids:
            moves = self.moves.setdefault(state, {})
            move = moves.get(token)
            if move is None:
                move = moves[token] = self.push(state, self.tokens[token])
                if not state and not move[0]:
                    self.plain[token] = move[1]
            state, text = move
            yield text
        if state:
            yield "�"

    def __call__(self, ids: list[int]) -> str:
        try:  # as long as every token is made of whole characters, the state stays the same
            return "".join([self.plain[token] for token in ids])
        except KeyError:
            return "".join(self.stream(ids))


@functools.lru_cache(maxsize=2)
def _encoder(path: str, pattern: str, most_known: int, most_states: int) -> Encoder:
    """One for a worker process, which serves many tasks."""
    return Encoder(load_ranks(path), pattern, most_known, most_states)


@functools.lru_cache(maxsize=2)
def _machine(path: str) -> Utf8Machine:
    return Utf8Machine({rank: token for token, rank in load_ranks(path).items()})


def _batched(batches: Iterator[pa.RecordBatch], sizes, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of limited size; one row at least."""
    for batch in batches:
        ends = np.cumsum(np.nan_to_num(np.asarray(sizes(batch.column(1)), float)))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    text: str = "text",
    columns: list[str] | None = None,
    back: bool = False,
    most_known: int = MAX_KNOWN,
    most_states: int = MAX_STATES,
) -> DataFrame:
    """``row`` with the given columns (all by default) and ``ids``, the tokens of the whole text.

    ``back`` adds ``decoded``, as ``decode`` does, in the same pass over the data. The last two
    bound what a worker keeps from text to text, about 400 bytes each; less costs time.

    ``path`` names a file of ranks that every executor can open. Null and empty texts have no
    tokens. Special tokens are not known; their strings are ordinary text. Repeated rows give
    repeated rows, an empty table none; other columns pass through in ``row``.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns or docs.columns]).alias("row"),
        F.col(text).alias("text"),
    )
    schema = rows.select("row").schema.add("ids", T.ArrayType(T.IntegerType()))
    if back:
        schema = schema.add("decoded", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern, most_known, most_states)
        for batch in _batched(batches, pc.binary_length, BYTES):
            gc.disable()  # states are many small tuples without cycles
            ids, decoded = encoder.batch(batch.column(1), _machine(path) if back else None)
            gc.enable()
            columns = [batch.column(0), ids]
            if back:
                columns.append(pa.array(decoded, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded`` to ``row`` and ``ids``: the text of the tokens. Null ids give null."""
    schema = encoded.select("row", "ids").schema.add("decoded", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(path)
        for batch in _batched(batches, pc.list_value_length, TOKENS):
            columns = [batch.column(0), batch.column(1), _decoded(batch.column(1), machine)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "ids", "decoded"])

    return encoded.select("row", "ids").mapInArrow(run, schema)


def _decoded(ids: pa.ListArray, machine: Utf8Machine) -> pa.StringArray:
    return pa.array((machine(x.values.to_pylist()) if x.is_valid else None for x in ids), pa.string())


def digests(decoded: DataFrame) -> list:
    """Columns that stand for the results: number of tokens, hash of the ids, hash of the text."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]
