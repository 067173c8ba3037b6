"""Licences: each template by itself, small changes, other licences, texts without."""

import pytest
from wayfare.llm import licenses

NOISE = "the quick brown fox jumps over the lazy dog and runs away. " * 5


@pytest.mark.parametrize(("licence", "text"), [(x, s.format(n)) for x, n, _ in licenses.NAMES for s in licenses.SENTENCES])
def test_named(licence, text):
    assert [f.licence for f in licenses.scan(text)] == [licence]
    assert [f.licence for f in licenses.scan(f"{NOISE}\n{text}\n{NOISE}")] == [licence]


@pytest.mark.parametrize(("licence", "text"), [(x, t) for x, t, _ in licenses.GRANTS])
def test_carried(licence, text):
    wrapped = NOISE + "\n# " + text.replace("\n", "\n# ").upper() + "\n" + NOISE
    found = licenses.scan(wrapped)
    assert [f.licence for f in found] == [licence] and found[0].missing == 0
    inside = wrapped[found[0].start : found[0].end]
    assert licenses.words_of(inside) == found[0].wording.split()


def test_two_in_one_block():
    found = licenses.scan("Released under the MIT License. Licensed under CC BY-NC 4.0.")
    assert [f.licence for f in found] == ["MIT", "CC-BY-NC-4.0"]


def test_exact_wording_decides():
    apache = "Licensed under the Apache License, Version 2.0."
    assert licenses.scan(apache.replace("2.0", "1.1")) == []
    changed = dict((x, t) for x, t, _ in licenses.GRANTS)["MIT"].replace("merge, ", "").replace("free of charge", "free of cost")
    found = licenses.scan(changed)
    assert [f.licence for f in found] == ["MIT"] and found[0].missing >= 2


@pytest.mark.parametrize(("licence", "line"), [("CC-BY-4.0", "Licensed under CC BY 4.0."), ("MIT", "Licensed under the MIT License."), ("EPL-2.0", "Licensed under the Eclipse Public License, version 2.0."), ("ISC", "Released under the ISC License.")])
def test_short_wording_beside_long_ones(licence, line):
    grants = dict((x, t) for x, t, _ in licenses.GRANTS)
    names = ["BSD-2-Clause", "MPL-2.0", "Unlicense", "GPL-2.0"]
    found = licenses.scan("\n".join([*(grants[x] for x in names), line]))
    assert [f.licence for f in found] == [*names, licence]
    assert found[-1].missing == found[-1].added == 0


def test_every_copy_in_one_block():
    line = "Released under the MIT License."
    assert [(f.licence, f.start) for f in licenses.scan("\n".join([line] * 50))] == [("MIT", 32 * k) for k in range(50)]
    grant = dict((x, t) for x, t, _ in licenses.GRANTS)["MIT"]
    words = grant.split()
    copies = []
    for share in (60, 38):  # one word changed
        at = len(words) * share // 100
        copies.append(" ".join([*words[:at], "otherwise", *words[at + 1 :]]))
    found = licenses.scan("\n".join([*copies, *copies]))
    assert [f.licence for f in found] == ["MIT"] * 4 and all(f.missing == f.added == 1 for f in found)


@pytest.mark.parametrize("text", [None, "", "my driving license expired", "with permission of the author", "copyright 2020 somebody", NOISE, "licens " * 2000])
def test_none(text):
    assert licenses.scan(text) == []


def test_table(spark):
    schema = "doc_id long, text string, licence string, start string"
    data = [(1, "x. Released under the MIT License.", "own", "own"), (1, "x. Released under the MIT License.", "own", "own"), (2, None, None, None), (3, "", "", ""), (None, "Licensed under CC BY 4.0.", "", "")]
    got = licenses.license_scan(spark.createDataFrame(data, schema)).collect()
    assert sorted((str(r.row.doc_id), r.licence) for r in got) == [("1", "MIT"), ("1", "MIT"), ("None", "CC-BY-4.0")]
    assert licenses.license_scan(spark.createDataFrame([], schema)).collect() == []


def test_compression_decides(monkeypatch):
    """With compressors to which all is alike no wording is found."""
    text = "Released under the MIT License."
    assert [f.licence for f in licenses.scan(text)] == ["MIT"]

    class Alike:
        def compress(self, data):
            return b"x" * 20

    known = tuple(t._replace(compressor=Alike()) for t in licenses.templates()[0])
    monkeypatch.setattr(licenses, "templates", lambda: (known, Alike()))
    assert licenses.scan(text) == []


def test_every_wording_that_may_count_saves_enough():
    """Any one word changed, or a tenth of a long wording: far above the bytes that have to be saved."""
    known, plain = licenses.templates()
    for t in known:
        most = int(licenses.most_of(t))
        for at in range(len(t.words)):
            step = max(1, len(t.words) // most)
            gone = {(at + step * k) % len(t.words) for k in range(most)}
            words = [f"zq{k}" if k in gone else w for k, w in enumerate(t.words)]
            alone, left = licenses.sizes_of(t, plain, words)
            if t.fixed <= set(words):
                assert alone - left >= 2 * licenses.MIN_GAIN * t.alone


def test_what_explains_most_stays():
    """Of wordings over each other the one that saves most, whichever template comes first."""
    bsd = dict((x, t) for x, t, _ in licenses.GRANTS)
    for licence in ("BSD-2-Clause", "BSD-3-Clause"):
        (found,) = licenses.scan(bsd[licence])
        assert (found.licence, found.missing, found.added) == (licence, 0, 0) and found.gain > 0.6
    (found,) = licenses.scan("Distributed under the terms of the MIT License.")
    assert found.wording == "distributed under the terms of the mit license"
