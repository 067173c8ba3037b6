"""Languages against a plain version with counters, and held-out accuracy."""

import random
import unicodedata
import zlib
from collections import Counter, defaultdict

import pandas as pd
import pytest
from wayfare.llm import language, queries

SCHEMA = "doc_id long, text string, lang string, score string, language string"
WORDS = {
    "en": "the and of with that which house river this have from they would there their what",
    "de": "der und die nicht straße über größe für ich auch schön haben werden einen eine",
    "el": "και το της για είναι ότι από μια στο δεν θα τον με που σπίτι",
    "hi": "और है में की यह नहीं हिन्दी को एक पर से किताब भाषा के लिए",
}


def plain_ngrams(text):
    text = (text or "").lower()
    if not any(c.isalpha() for c in text):
        return Counter()
    words = "".join(c if c.isalpha() or unicodedata.category(c)[0] == "M" else " " for c in text).split()
    found = Counter()
    for word in words:
        found.update(word)
        found.update(f" {word} "[k : k + n] for n in (2, 3) for k in range(len(word) + 3 - n))
    return found


def plain_places(counts, places):
    order = sorted(counts, key=lambda g: (-counts[g], packed(g)))
    return {gram: k for k, gram in enumerate(order[:places])}


def packed(gram):
    code = 0
    for c in gram:
        code = code << 21 | ord(c)
    return code


def plain_predict(text, profiles, places):
    own = plain_places(plain_ngrams(text), places)
    if not own:
        return "und", 0.0
    far = {
        name: sum(abs(profile[g] - k) if g in profile else places for g, k in own.items())
        for name, profile in profiles.items()
    }
    best = min(sorted(far), key=far.get)
    return best, 1 - far[best] / (len(own) * places)


def random_text(rng, name, n):
    marks = [" ", " ", " ", "  ", "\n", ", ", ". ", " 12 ", " — ", "'"]
    return "".join(rng.choice(WORDS[name].split()) + rng.choice(marks) for _ in range(n))


ODD = [None, "", " ", "123 !!", "́", "x", "É", "İ", "áb", "ßß", "\U0001f600 a", "日本語", "the " * 100_000, "a'b", "\x00a"]


def test_ngrams_are_those_of_words():
    rng = random.Random(1)
    texts = ODD + [random_text(rng, rng.choice(list(WORDS)), rng.randint(0, 30)) for _ in range(200)]
    document, code, count = language.ngrams(texts)
    got = defaultdict(dict)
    for d, c, n in zip(document.tolist(), code.tolist(), count.tolist()):
        assert c not in got[d]
        got[d][c] = n
    for k, text in enumerate(texts):
        assert got[k] == {packed(g): n for g, n in plain_ngrams(text).items()}, repr(text)[:80]


@pytest.mark.parametrize("places, held", [(300, 1_000_000), (20, 10)])
def test_equals_plain_profiles(spark, monkeypatch, places, held):
    monkeypatch.setattr(language, "HELD", held)  # tasks hand on after every slice
    rng = random.Random(2)
    rows = [(random_text(rng, name, rng.randint(1, 20)), name) for name in WORDS for _ in range(30)]
    rows += [(t, rng.choice([*WORDS, None])) for t in ODD] + rows[:10]
    docs = spark.createDataFrame([(k, t, name, "clash", "clash") for k, (t, name) in enumerate(rows)], SCHEMA).repartition(4)
    model = language.fit(docs, places=places)
    counts = defaultdict(Counter)
    for text, name in rows:
        if name is not None and text is not None and plain_ngrams(text):
            counts[name].update(plain_ngrams(text))
    profiles = {name: plain_places(own, places) for name, own in counts.items()}
    assert model.languages == sorted(profiles)
    got = language.identified(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain_predict(r.row.text, profiles, places)
        assert (r.language, round(r.score, 9)) == (want[0], round(want[1], 9)), r.row.text
        assert (r.row.score, r.row.language) == ("clash", "clash")


def test_sample_is_bounded(spark):
    docs = spark.range(20_000).selectExpr("cast(id as string) || ' text' as text", "if(id < 15000, 'a', 'b') as lang")
    sizes = {r.language: r["count"] for r in language.sampled(docs, "text", "lang", 6_000).groupBy("language").count().collect()}
    assert sizes["b"] == 5_000 and 5_500 < sizes["a"] < 6_500


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    model = language.fit(none)
    assert language.identified(none, model).collect() == []
    some = spark.createDataFrame([(1, "text", None, "", "")], SCHEMA)
    assert [(r.language, r.score) for r in language.identified(some, model).collect()] == [("und", 0.0)]


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.op11_language_id(spark, sf_dir).toPandas()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    assert got.score.between(0, 1).all()
    both = pd.read_parquet(f"{sf_dir}/documents.parquet").merge(got[got.held_out], on="doc_id")
    both = both[both.lang_pred != "und"]
    assert len(both) > 150 and (both.lang == both.lang_pred).mean() > 0.95
