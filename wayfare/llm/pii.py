"""Personal data replaced by surrogates.

What identifies a person or opens a door (addresses, numbers, secrets, names behind a title) is
replaced by a value of the same type and form. The value depends on a secret key and the entity
alone, so an entity gets one surrogate wherever it occurs, however it is written there. Two
entities never share a surrogate, and no surrogate is an entity of the corpus: a table of all
distinct entities is checked for collisions, and who loses draws again. Only the few that drew
again have to be looked up when texts are written; all others follow from the key.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.text import stored

WIDER = 16  # draws after which a surrogate gets longer, if its form allows
HELD = 200_000  # distinct entities a task holds before it hands them on
ROWS = 512

DIGITS = "0123456789"
HEX = "0123456789abcdef"
LOWER = "abcdefghijklmnopqrstuvwxyz"


class Mention(NamedTuple):
    start: int
    end: int
    kind: str
    entity: str  # one form for all ways to write it


# ---- detection ----------------------------------------------------------------------------------

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
EMAIL = re.compile(r"(?<![\w.+-])\w[\w.+-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![\w@])")
PHONE = re.compile(
    r"(?<![\w+])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|(?<![\w+])\+(?!1[ .(-])\d{1,3}[ -]?(?:\(\d{1,4}\)[ -]?)?\d{2,4}(?:[ -]\d{2,4}){1,4}(?!\d)"
    r"|(?<![\w+])\+[1-9]\d{7,14}(?!\d)"
    r"|(?<![\w(+])\(\d{3}\) ?\d{3}[.-]\d{4}(?!\d)"
    r"|(?<![\w.+-])\d{3}([.-])\d{3}\1\d{4}(?![\w-])"
)
CARD = re.compile(
    r"(?<![\w.+-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?![\w-]|\.\d)"
)
# First digits of the large card issuers, with the numbers of digits they use.
ISSUERS = (
    (re.compile(r"4"), (13, 16, 19)),
    (re.compile(r"5[1-5]|222[1-9]|22[3-9]|2[3-6]|27[01]|2720"), (16,)),
    (re.compile(r"3[47]"), (15,)),
    (re.compile(r"6011|64[4-9]|65"), (16, 19)),
    (re.compile(r"35(?:2[89]|[3-8])"), (16,)),
    (re.compile(r"30[0-5]|36|3[89]"), (14,)),
)
IPV4 = re.compile(rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)")
IPV6 = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")
SSN = re.compile(r"(?<![\w-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])")
IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
KEYS = re.compile(
    r"(?<!\w)(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_-]{20,}"
    r"|xox[abpr]-[A-Za-z0-9-]{10,}|eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{8,})(?![\w])"
)
ASSIGNED = re.compile(
    r"\b(?:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key)\b[\"']?\s*[=:]\s*"
    r"(?:\"(?=[^\"]*\d)([^\"\s]{6,})\"|'(?=[^']*\d)([^'\s]{6,})'|(?=[\w+/=-]*\d)([\w+/=-]{6,}))",
    re.I,
)

# Titles that name a person, with the gender they tell.
TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Dr": "", "Prof": "",
    "Herr": "m", "Herrn": "m", "Frau": "f", "Fräulein": "f", "Monsieur": "m", "Madame": "f", "Mme": "f",
    "Mlle": "f", "Señor": "m", "Señora": "f", "Señorita": "f", "Sr": "m", "Sra": "f", "Srta": "f", "Doña": "f",
    "господин": "m", "госпожа": "f", "г-н": "m", "г-жа": "f", "κύριος": "m", "κυρία": "f",
}
_UPPER = r"[^\W\d_a-zß-öø-ÿа-яα-ω]"
NAME = re.compile(
    r"(?<!\w)(" + "|".join(sorted(TITLES, key=len, reverse=True)) + r")\.?[  ]"
    rf"({_UPPER}[^\W\d_]+(?:['’-][^\W\d_]+)?(?: {_UPPER}[^\W\d_]+(?:['’-][^\W\d_]+)?){{0,2}})(?!\w)"
)
_DIGIT = re.compile(r"\d")


def luhn(digits: str) -> int:
    """Sum of the check over the digits; a valid number gives a multiple of ten."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total


def issuer(digits: str) -> str | None:
    """First digits that tell the issuer, None if no issuer numbers cards so."""
    for first, lengths in ISSUERS:
        found = first.match(digits)
        if found and len(digits) in lengths:
            return found.group()
    return None


def _iban_rest(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def script(word: str) -> str:
    if any("Ѐ" <= c <= "ӿ" for c in word):
        return "cyrillic"
    return "greek" if any("Ͱ" <= c <= "Ͽ" for c in word) else "latin"


def _names(text: str) -> Iterator[Mention]:
    """Words of names behind a title, and the same words elsewhere in the text."""
    words: dict[str, str] = {}
    for found in NAME.finditer(text):
        parts = found.group(2).split(" ")
        for k, word in enumerate(parts):
            gender = TITLES[found.group(1)]
            kind = f"given-{gender}-{script(word)}" if k < len(parts) - 1 else f"surname--{script(word)}"
            # A gender that one mention tells holds for the others.
            if word not in words or words[word].split("-")[1] == "":
                words[word] = kind
    words |= {word.upper(): kind for word, kind in words.items() if len(word) > 2}
    if words:
        again = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(words, key=len, reverse=True))) + r")(?!\w)")
        for found in again.finditer(text):
            yield Mention(*found.span(), words[found.group()], found.group().lower())


def mentions(text: str | None) -> list[Mention]:
    """All mentions of a text, in order, none over another."""
    if not text:
        return []
    found: list[Mention] = []
    if "@" in text:
        found += [Mention(*m.span(), "email", m.group().lower()) for m in EMAIL.finditer(text)]
    if _DIGIT.search(text):
        for m in ASSIGNED.finditer(text):
            group = m.lastindex
            found.append(Mention(*m.span(group), "secret", m.group(group)))
        found += [Mention(*m.span(), "secret", m.group()) for m in KEYS.finditer(text)]
        for m in IBAN.finditer(text):
            plain = m.group().replace(" ", "")
            if 15 <= len(plain) <= 34 and _iban_rest(plain) == 1:
                found.append(Mention(*m.span(), "iban", plain))
        for m in CARD.finditer(text):
            plain = _digits(m.group())
            if issuer(plain) and luhn(plain) % 10 == 0:
                found.append(Mention(*m.span(), "card", plain))
        for m in PHONE.finditer(text):
            plain = _digits(m.group())
            if 8 <= len(plain) <= 15:
                found.append(Mention(*m.span(), "phone", plain[-10:] if len(plain) == 11 and plain[0] == "1" else plain))
        for m in IPV4.finditer(text):
            if not m.group().startswith(("127.", "0.", "255.")):
                found.append(Mention(*m.span(), "ipv4", m.group()))
        found += [Mention(*m.span(), "ipv6", m.group().lower()) for m in IPV6.finditer(text)]
        found += [Mention(*m.span(), "ssn", _digits(m.group())) for m in SSN.finditer(text)]
    if any(title in text for title in TITLES):
        found += _names(text)
    # The first rule that claims a place keeps it; the rules are in the order of their certainty.
    kept: list[Mention] = []
    taken: set[int] = set()
    for m in found:
        if taken.isdisjoint(range(m.start, m.end)):
            taken.update(range(m.start, m.end))
            kept.append(m)
    return sorted(kept)


# ---- surrogates ---------------------------------------------------------------------------------


class Draw:
    """Choices that depend on a key, an entity and the number of the draw."""

    def __init__(self, key: str, *what: str | int):
        seed = "\x1f".join(map(str, what)).encode()
        self.value = int.from_bytes(hmac.digest(key.encode(), seed, hashlib.sha512), "big")
        self.seed, self.key, self.left = seed, key, 500

    def below(self, n: int) -> int:
        self.left -= n.bit_length() + 8
        if self.left < 0:
            self.seed += b"+"
            self.value = int.from_bytes(hmac.digest(self.key.encode(), self.seed, hashlib.sha512), "big")
            self.left = 490 - n.bit_length()
        self.value, choice = divmod(self.value, n)
        return choice

    def of(self, letters: str) -> str:
        return letters[self.below(len(letters))]


def _shaped(draw: Draw, text: str, hexadecimal: bool = True) -> str:
    """Digits for digits, letters for letters of the same case; hexadecimal stays hexadecimal."""
    small = text.lower()
    if hexadecimal and len(text) >= 8 and all(c in HEX for c in small) and _DIGIT.search(text):
        made = "".join(draw.of(HEX) for _ in text)
        return made.upper() if text.upper() == text else made
    out = []
    for c in text:
        if c in DIGITS:
            out.append(draw.of(DIGITS))
        elif c.isalpha():
            letter = draw.of(LOWER)
            out.append(letter.upper() if c.isupper() else letter)
        else:
            out.append(c)
    return "".join(out)


# Sounds that names are made of, and how they end by gender.
_SOUNDS = {
    "latin": ("bdfgklmnprstv", "aeiou", {"m": ("n", "r", "s", "l"), "f": ("a", "ia", "ina"), "": ("en", "is", "or")}),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", {"m": ("н", "р", "л", "м"), "f": ("а", "ия", "ина"), "": ("ин", "ер", "ис")}),
    "greek": ("βγδζκλμνπρστφ", "αειου", {"m": ("ος", "ης", "ας"), "f": ("α", "η", "ια"), "": ("ου", "ις", "ων")}),
}
_KEPT = {"AKIA": 4, "ASIA": 4, "sk-": 3, "eyJ": 3}


def surrogate(key: str, kind: str, entity: str, attempt: int) -> str:
    """The value that a draw gives for an entity, in the form of ``entity``."""
    draw = Draw(key, kind, entity, attempt)
    longer = attempt // WIDER
    if kind == "email":
        local, _, domain = entity.rpartition("@")
        labels = domain.split(".")
        place = Draw(key, "domain", domain)
        host = [_shaped(place, label) for label in labels[:-1]]
        return _shaped(draw, local + "0" * longer) + "@" + ".".join([*host, labels[-1]])
    if kind == "card":
        first = issuer(entity) or ""
        body = first + "".join(draw.of(DIGITS) for _ in entity[len(first) : -1])
        return body + str(-luhn(body + "0") % 10)
    if kind == "phone":
        code = entity[:2] if len(entity) > 10 else ""
        made = [draw.of(DIGITS[1:] if c != "0" else DIGITS) for c in entity[len(code) :]]
        return code + "".join(made)
    if kind == "ssn":
        area = 1 + draw.below(898)
        return f"{area + (area >= 666):03}{1 + draw.below(99):02}{1 + draw.below(9999):04}"
    if kind == "ipv4":
        octets = entity.split(".")
        fixed = 1 if octets[0] == "10" else 2 if octets[:2] == ["192", "168"] else 0
        if octets[0] == "172" and 16 <= int(octets[1]) < 32:
            fixed = 2
        if fixed and not longer:
            made = octets[:fixed]
        else:
            first = 11 + draw.below(180)
            made = [str(first + (first >= 127) + (first >= 171))]
        made += [str(draw.below(256)) for _ in range(3 - len(made))]
        return ".".join([*made, str(1 + draw.below(254))])
    if kind == "iban":
        body = entity[:2] + "00" + _shaped(draw, entity[4:], hexadecimal=False).upper()
        return f"{body[:2]}{98 - _iban_rest(body):02}{body[4:]}"
    if kind == "ipv6":
        return ":".join("".join(draw.of(HEX) for _ in group) for group in entity.split(":"))
    if kind == "secret":
        fixed = next((n for head, n in _KEPT.items() if entity.startswith(head)), 0)
        if re.match(r"gh[pousr]_|xox[abpr]-", entity):
            fixed = 4
        return entity[:fixed] + _shaped(draw, entity[fixed:] + "0" * longer)
    _, gender, letters = kind.split("-")
    consonants, vowels, endings = _SOUNDS[letters]
    sounds = "".join(draw.of(consonants) + draw.of(vowels) for _ in range(2 + longer))
    ends = endings[gender]
    return sounds + draw.of(consonants) + ends[draw.below(len(ends))]


def family(kind: str) -> str:
    """Kinds whose surrogates must differ from each other."""
    return "name" if "-" in kind else kind


def written(value: str, mention: str, kind: str) -> str:
    """A surrogate in the way the mention is written: its marks between digits, its case."""
    if kind in ("card", "phone", "ssn", "iban"):
        marks = [c for c in mention if c.isalnum()]
        if kind == "phone" and len(marks) == 11 and len(value) == 10:
            value = marks[0] + value
        if len(marks) == len(value):
            rest = iter(value)
            return "".join(next(rest) if c.isalnum() else c for c in mention)
        return value
    if "-" in kind:
        return value.upper() if len(mention) > 1 and mention.isupper() else value.capitalize()
    if kind in ("email", "ipv6") and mention.isupper():
        return value.upper()
    return value


def replaced(text: str, key: str, attempts: dict[tuple[str, str], int], draw=surrogate) -> tuple[str, list[Mention]]:
    found = mentions(text)
    out, at = [], 0
    for m in found:
        value = draw(key, m.kind, m.entity, attempts.get((m.kind, m.entity), 0))
        out += [text[at : m.start], written(value, text[m.start : m.end], m.kind)]
        at = m.end
    return "".join([*out, text[at:]]), found


# ---- the corpus ---------------------------------------------------------------------------------


def entities(docs: DataFrame, text: str) -> DataFrame:
    """(kind, entity), once for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: set[tuple[str, str]] = set()

        def hand_on() -> pa.RecordBatch:
            kinds, values = zip(*held)
            return pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(values)], ["kind", "entity"])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.update((m.kind, m.entity) for m in mentions(t))
                if len(held) > HELD:
                    yield hand_on()
                    held.clear()
        if held:
            yield hand_on()

    return docs.select(F.col(text)).mapInArrow(run, "kind string, entity string").distinct()


def _drawn(table: DataFrame, key: str) -> DataFrame:
    """(family, kind, entity, attempt, value) from (kind, entity, attempt)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            values = pa.array([surrogate(key, *row) for row in rows], pa.string())
            families = pa.array([family(row[0]) for row in rows], pa.string())
            names = ["family", "kind", "entity", "attempt", "value"]
            yield pa.RecordBatch.from_arrays([families, *batch.columns, values], names)

    schema = "family string, kind string, entity string, attempt int, value string"
    return table.select("kind", "entity", "attempt").mapInArrow(run, schema)


def redrawn(found: DataFrame, key: str) -> DataFrame:
    """(kind, entity, attempt) of the entities whose first draws collide.

    A draw is lost if it gives an entity of the corpus, or what another entity holds or draws at the
    same time; of the latter the smallest keeps it. Every round is a join over all entities, and
    only the losers go into the next.
    """
    originals = stored(
        _drawn(found.withColumn("attempt", F.lit(0)), key).select("family", F.col("entity").alias("value")).distinct(),
        "originals",
    )
    open_draws = found.withColumn("attempt", F.lit(0))
    settled = None
    while True:
        drawn = stored(_drawn(open_draws, key), "drawn")
        clean = drawn.join(originals, ["family", "value"], "left_anti")
        if settled is not None:
            clean = clean.join(settled.select("family", "value"), ["family", "value"], "left_anti")
        first = clean.groupBy("family", "value").agg(F.min(F.struct("entity", "kind")).alias("w"))
        won = stored(
            clean.join(first, ["family", "value"]).where(F.struct("entity", "kind") == F.col("w")).drop("w"), "won"
        )
        settled = won if settled is None else stored(settled.unionByName(won), "settled")
        lost = drawn.join(won.select("kind", "entity"), ["kind", "entity"], "left_anti")
        open_draws = stored(lost.select("kind", "entity", (F.col("attempt") + 1).alias("attempt")), "lost")
        if open_draws.isEmpty():
            return settled.where("attempt > 0").select("kind", "entity", "attempt")


def anonymised(
    docs: DataFrame, key: str, text: str = "text", columns: list[str] | None = None
) -> DataFrame:
    """``row`` with the given columns (all by default), ``clean``: the text with surrogates, and
    ``found``: (kind, start, length) of every mention in the text as it was, in code points.

    Null text stays null, empty text empty; a text without personal data comes back as it is.
    Repeated rows give repeated rows with the same surrogates; an empty table gives none; other
    columns pass through in ``row``.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns or docs.columns]).alias("row"),
        F.col(text).alias("text"),
    )
    again = stored(redrawn(stored(entities(docs, text), "entities"), key), "redrawn")
    # Which texts hold one of those that drew again. Texts that share a hash may share the list.
    hits = (
        _hits(rows)
        .join(again, ["kind", "entity"])
        .groupBy("hash")
        .agg(F.collect_set(F.struct("kind", "entity", "attempt")).alias("again"))
    )
    hits = stored(hits, "texts-with-redrawn")
    joined = rows.withColumn("hash", F.xxhash64("text")).join(hits, "hash", "left").select("row", "text", "again")
    span = T.StructType().add("kind", T.StringType()).add("start", T.IntegerType()).add("length", T.IntegerType())
    schema = rows.select("row").schema.add("clean", T.StringType()).add("found", T.ArrayType(span))
    drawn = lru_cache(maxsize=100_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = drawn(surrogate)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                texts, spans = [], []
                for t, more in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    attempts = {(a["kind"], a["entity"]): a["attempt"] for a in more or ()}
                    clean, found = (None, []) if t is None else replaced(t, key, attempts, draw)
                    texts.append(clean)
                    spans.append(
                        [{"kind": m.kind, "start": m.start, "length": m.end - m.start} for m in found]
                    )
                made = [pa.array(texts, pa.string()), pa.array(spans, _SPANS)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["row", "clean", "found"])

    return joined.mapInArrow(run, schema)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))


def _hits(rows: DataFrame) -> DataFrame:
    """(hash of the text, kind, entity), once for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {
                (h, m.kind, m.entity)
                for h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for m in mentions(t)
            }
            if found:
                columns = [pa.array(c) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays(columns, ["hash", "kind", "entity"])

    hashed = rows.select(F.xxhash64("text").alias("hash"), "text")
    return hashed.mapInArrow(run, "hash long, kind string, entity string").distinct()
