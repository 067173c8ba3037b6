"""Which licences a text names or carries, by conditional compression.

A block that repeats a known wording gets much smaller when it is compressed with that wording as a
dictionary. Around words that licences use, each window that could hold a template is compressed with and
without it. Where that saves enough, the window is compared word by word: only a wording that is there, but
for a few words and never for a name or a version, counts. Of wordings over each other that stays which
explains most: the bytes it saves, less those that are left. Windows are no longer than their template asks
for, so a long wording hides no short one beside it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEVEL = 19
MAX_MISSING = 0.1  # share of a template's words that a block may lack
MIN_GAIN = 0.05  # bytes to save, as a share of the template's; with the words that may lack it is more
GAP = 2  # sentences without a cue that a block may hold
AROUND = 120  # characters looked at on either side of a block

_GRANT_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software."""
_GRANT_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""
_GRANT_APACHE = """you may not use this file except in compliance with the License. You may obtain a copy of the
License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied."""
_GRANT_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce
the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
other materials provided with the distribution."""
_GRANT_BSD3 = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission."""
_GRANT_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
_GRANT_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the
GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your
option) any later version."""
_GRANT_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to
copy, modify, publish, use, compile, sell, or distribute this software."""

# Ways in which one line names a licence; what stands for the name is in NAMES.
SENTENCES = (
    "Licensed under the {}.",
    "Released under the {}.",
    "This work is licensed under the {}.",
    "Distributed under the terms of the {}.",
    "Available under the {}.",
)
# Licence, its name in such sentences, and the words that must be there unchanged.
NAMES = (
    ("MIT", "MIT License", "mit"),
    ("Apache-2.0", "Apache License, Version 2.0", "apache 2.0"),
    ("GPL-2.0", "GNU General Public License, version 2", "gnu general 2"),
    ("GPL-3.0", "GNU General Public License, version 3", "gnu general 3"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1", "gnu lesser 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3", "gnu lesser 3"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3", "gnu affero 3"),
    ("MPL-2.0", "Mozilla Public License, version 2.0", "mozilla 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License", "bsd 2"),
    ("BSD-3-Clause", "BSD 3-Clause License", "bsd 3"),
    ("ISC", "ISC License", "isc"),
    ("EPL-2.0", "Eclipse Public License, version 2.0", "eclipse 2.0"),
    *(
        (f"CC-{kind}-{version}", f"CC {kind} {version}", f"cc {kind.lower().replace('-', ' ')} {version}")
        for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
        for version in ("3.0", "4.0")
    ),
)
GRANTS = (
    ("MIT", _GRANT_MIT, "permission granted"),
    ("ISC", _GRANT_ISC, "fee granted"),
    ("Apache-2.0", _GRANT_APACHE, "license 2.0"),
    ("BSD-2-Clause", _GRANT_BSD, "redistribution binary"),
    ("BSD-3-Clause", _GRANT_BSD + " " + _GRANT_BSD3, "redistribution binary endorse"),
    ("MPL-2.0", _GRANT_MPL, "mozilla 2.0"),
    ("Unlicense", _GRANT_UNLICENSE, "unencumbered"),
    *(
        (f"{short}-{version}.0", _GRANT_GNU.format(name=name, version=version), f"gnu {key} {version}")
        for short, name, key, version in (
            ("GPL", "General Public License", "general", "2"),
            ("GPL", "General Public License", "general", "3"),
            ("LGPL", "Lesser General Public License", "lesser", "3"),
            ("AGPL", "Affero General Public License", "affero", "3"),
        )
    ),
)

# A text without any of these has no licence in it.
CUES = (
    "licens", "licenc", "copyright", "permission", "redistribut", "warrant", "free software", "spdx",
    "unencumbered", "cc by",
)
_CUE = re.compile("|".join(CUES))
_SENTENCE = re.compile(r"[^\n]*?(?:[.!?](?=\s)|\n|$)")
_WORD = re.compile(r"[A-Za-z]+|\d+(?:\.\d+)*")


class Template(NamedTuple):
    licence: str
    words: tuple[str, ...]
    counts: Counter
    fixed: frozenset[str]
    alone: int  # bytes it compresses to
    compressor: zstandard.ZstdCompressor


class Finding(NamedTuple):
    licence: str
    start: int
    end: int
    gain: float
    missing: int
    added: int
    wording: str


def words_of(text: str) -> list[str]:
    return [word for word, _, _ in _spans(text)]


def _spans(text: str) -> list[tuple[str, int, int]]:
    return [(m.group().lower(), *m.span()) for m in _WORD.finditer(text)]


@lru_cache(maxsize=1)
def templates() -> tuple[tuple[Template, ...], zstandard.ZstdCompressor]:
    plain = zstandard.ZstdCompressor(level=LEVEL)
    texts = []
    for licence, name, fixed in NAMES:
        for sentence in SENTENCES:
            if name.startswith("CC "):  # named without an article
                sentence = sentence.replace("the {}", "{}")
            texts.append((licence, sentence.format(name), fixed))
    texts += [(x, f"SPDX-License-Identifier: {x}", f"spdx {' '.join(words_of(x))}") for x, _, _ in NAMES]
    made = []
    for licence, text, fixed in [*texts, *GRANTS]:
        words = tuple(words_of(text))
        data = " ".join(words).encode()
        dictionary = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        alone = len(plain.compress(data))
        made.append(Template(licence, words, Counter(words), frozenset(words_of(fixed)), alone, compressor))
    return tuple(made), plain


def blocks(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of runs of sentences with cues, with the sentences between them."""
    start = end = None
    gap = 0
    for found in _SENTENCE.finditer(text):
        if found.start() == found.end():
            continue
        if _CUE.search(found.group().lower()):
            if start is not None and gap > GAP:
                yield start, end
                start = None
            start = found.start() if start is None else start
            end, gap = found.end(), 0
        elif found.group().strip():
            gap += 1
    if start is not None:
        yield start, end


def may_hold(template: Template, held: Counter) -> bool:
    """Whether words have all that may not change, and no more of the template is missing than may."""
    if not all(word in held for word in template.fixed):
        return False
    missing = sum(max(0, n - held[word]) for word, n in template.counts.items())
    return missing <= most_of(template)


def most_of(template: Template) -> float:
    """How many words of a template a block may lack."""
    return max(1, MAX_MISSING * len(template.words))


def compared(template: Template, words: list[str]) -> tuple[int, int, int, int] | None:
    """(first word, last word, missing, added) of the wording in a block, None if it is not there."""
    matcher = SequenceMatcher(None, template.words, words, autojunk=False)
    runs = [m for m in matcher.get_matching_blocks() if m.size]
    same = sum(m.size for m in runs)
    missing = len(template.words) - same
    most = most_of(template)
    if missing > most or not runs:
        return None
    kept = {template.words[k] for m in runs for k in range(m.a, m.a + m.size)}
    if not template.fixed <= kept:
        return None
    first, last = runs[0].b, runs[-1].b + runs[-1].size
    added = last - first - same
    return (first, last, missing, added) if added <= missing + most else None


def sizes_of(template: Template, plain: zstandard.ZstdCompressor, words: list[str]) -> tuple[int, int]:
    """Bytes that words compress to, alone and with the template as dictionary."""
    data = " ".join(words).encode()
    return len(plain.compress(data)), len(template.compressor.compress(data))


def placed(words: list[str]) -> list[tuple[int, int, int, float, int, int]]:
    """(first word, last word, template, gain, missing, added) of wordings, none over another, in order.

    A wording holds each word that may not change. So each place of one such word, the rarest, is looked
    at with as many words around it as the wording can take up there.
    """
    known, plain = templates()
    held = Counter(words)
    places: dict[str, list[int]] = {}
    for at, word in enumerate(words):
        places.setdefault(word, []).append(at)
    confirmed = set()
    for k, template in enumerate(known):
        if not may_hold(template, held):
            continue
        size = len(template.words)
        slack = int(2 * most_of(template))
        rare = min(template.fixed, key=lambda word: (held[word] * template.counts[word], word))
        windows = set()
        for own in (q for q, word in enumerate(template.words) if word == rare):
            for at in places[rare]:
                # The narrower ones keep out words of a copy next to it.
                for more in (slack, slack // 2, 0):
                    windows.add((max(0, at - own - more), min(len(words), at - own + size + more)))
        for low, high in windows:
            window = words[low:high]
            if not may_hold(template, Counter(window)):
                continue
            alone, left = sizes_of(template, plain, window)
            found = compared(template, window) if alone - left >= MIN_GAIN * template.alone else None
            if found:
                first, last, missing, added = found
                alone, left = sizes_of(template, plain, window[first:last])
                rank = (left - (alone - left), missing + added, -size, k)
                gain = (alone - left) / template.alone
                confirmed.add((rank, low + first, low + last, gain, missing, added))
    taken: set[int] = set()
    out = []
    for (_, _, _, k), first, last, gain, missing, added in sorted(confirmed):
        if taken.isdisjoint(range(first, last)):
            taken.update(range(first, last))
            out.append((first, last, k, gain, missing, added))
    return sorted(out)


def scan(text: str | None) -> list[Finding]:
    """All licences of a text, none over another, in order."""
    if not text:
        return []
    small = text.lower()
    if not any(cue in small for cue in CUES):
        return []
    known, _ = templates()
    out: list[Finding] = []
    for start, end in blocks(text):
        first_at = max(0, start - AROUND)
        spans = _spans(text[first_at : end + AROUND])
        words = [word for word, _, _ in spans]
        free = [(0, len(words))]
        while free:  # what lies left and right of the wordings found is looked through again
            low, high = free.pop()
            last_taken = low
            for first, last, k, gain, missing, added in placed(words[low:high]):
                first, last = low + first, low + last
                span = (first_at + spans[first][1], first_at + spans[last - 1][2])
                wording = " ".join(words[first:last])
                out.append(Finding(known[k].licence, *span, gain, missing, added, wording))
                free.append((last_taken, first))
                last_taken = last
            if last_taken > low:
                free.append((last_taken, high))
    # Blocks that are close may both show the same place, one of them cut off.
    kept: list[Finding] = []
    for f in sorted(out, key=lambda f: (f.missing + f.added, f.start - f.end, f.start)):
        at = bisect_left(kept, f.end, key=lambda g: g.start)
        if not at or kept[at - 1].end <= f.start:
            kept.insert(at, f)
    return kept


def license_scan(docs: DataFrame, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """One row for each licence found: ``row`` with the given columns (all by default), ``licence``,
    ``start`` and ``end`` of its wording in the text (code points), ``gain`` (bytes that compressing
    the wording with its template saves, as a share of the template's), ``missing`` and ``added`` words against the template, ``wording`` in plain words.

    Null and empty texts and texts without a licence give no row. Repeated rows give their rows again;
    an empty table gives none; other columns pass through in ``row``.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns or docs.columns]).alias("row"),
        F.col(text).alias("text"),
    )
    finding = T.StructType()
    for name, kind in (
        ("licence", T.StringType()), ("start", T.LongType()), ("end", T.LongType()), ("gain", T.DoubleType()),
        ("missing", T.LongType()), ("added", T.LongType()), ("wording", T.StringType()),
    ):
        finding = finding.add(name, kind)
    schema = T.StructType([rows.schema["row"], *finding.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for k, t in enumerate(batch.column(1).to_pylist()):
                for f in scan(t):
                    at.append(k)
                    found.append(f)
            if found:
                taken = batch.column(0).take(pa.array(at))
                columns = [pa.array(c) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays([taken, *columns], schema.names)

    return rows.mapInArrow(run, schema)
