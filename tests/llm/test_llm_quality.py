"""Quality: measures against plain Python, the estimate, edge cases."""

import random
import re
from collections import Counter

import pandas as pd
from wayfare.llm import quality

SCHEMA = "doc_id long, text string, words string, votes string, kept string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def texts():
    rng = random.Random(1)
    vocabulary = ["the", "of", "and", "é", "ж", "a#b", "x|", " ", " ", "😀", "\x1c", "long" * 30]
    made = ["".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "\t", "\r\n", "  ", "\x0b"]) for _ in range(rng.randint(0, 80))) for _ in range(150)]
    return [None, "", " ", "\n\n", "a", "a b", "a b c a b c", "a a a a", "x\r\nx\r\n\r\n", "word " * 30000, *made]


def test_measures(spark):
    data = [(k, t, "w", "v", "k") for k, t in enumerate(texts())]
    got = {r.row.doc_id: r for r in quality.judged(spark.createDataFrame(data, SCHEMA)).collect()}
    assert len(got) == len(data)
    for k, text, *_ in data:
        r = got[k]
        want = plain(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, repr(text)[:200]
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed is failed
        assert not (failed and r.kept)
        assert r.row.words == "w" and r.row.kept == "k"


def test_estimate_recovers_the_accuracy_of_rules():
    rng = random.Random(2)
    good = [{1: 0.7, 0: 0.25, -1: 0.05}, {1: 0.6, 0: 0.38, -1: 0.02}, {1: 0.0, 0: 0.97, -1: 0.03}]
    bad = [{1: 0.1, 0: 0.2, -1: 0.7}, {1: 0.2, 0: 0.2, -1: 0.6}, {1: 0.0, 0: 0.4, -1: 0.6}]
    rows, truth = [], []
    for _ in range(20000):
        kind = rng.random() < 0.8
        table = good if kind else bad
        rows.append(tuple(rng.choices(list(t), t.values())[0] for t in table))
        truth.append(kind)
    model = quality.estimate([(list(v), n) for v, n in Counter(rows).items()], 3)

    def posterior(votes):
        return model.bias + sum(w[v] for w, v in zip(model.weights, votes))

    right = sum((posterior(v) > 0) == t for v, t in zip(rows, truth)) / len(rows)
    best = sum((0.8 * _p(good, v) > 0.2 * _p(bad, v)) == t for v, t in zip(rows, truth)) / len(rows)
    assert right > best - 0.01


def _p(table, votes):
    out = 1.0
    for t, v in zip(table, votes):
        out *= t[v]
    return out


def test_labelled_documents(spark, sf_dir):
    judged = quality.judged(spark.read.parquet(f"{sf_dir}/documents.parquet"), columns=["doc_id"])
    got = judged.select("row.doc_id", "base_failed", "kept").toPandas()
    both = pd.read_parquet(f"{sf_dir}/labels.parquet").merge(got, on="doc_id")
    both = both[~both.base_failed]
    assert (both.kept == (both.quality == 1)).mean() > 0.97


def test_empty_table_and_no_bad_documents(spark):
    assert quality.judged(spark.createDataFrame([], SCHEMA)).collect() == []
    clean = "The house of the man is in the old town and it is near the river. " * 1
    words = [f"The man{k} of the house{k} and the dog{k} is in the town{k}. " * 1 for k in range(300)]
    data = [(k, "".join(words[k : k + 10]) + clean, "", "", "") for k in range(200)]
    assert all(r.kept for r in quality.judged(spark.createDataFrame(data, SCHEMA)).collect())
    assert quality.kept_rows(spark.createDataFrame(data, SCHEMA)).columns == ["doc_id", "text", "words", "votes", "kept"]


def test_function_words_of_other_scripts(spark):
    data = [(k, text, "", "", "") for k, text in enumerate(["дом стоит у реки. " * 20, "房子在河边 " * 20, "σπίτι δίπλα στο ποτάμι. " * 20, "house river town dog. " * 20, "1 2 3 4 5 " * 20])]
    voted = quality.with_votes(quality.with_measures(spark.createDataFrame(data, SCHEMA)))
    at = list(quality.RULES).index("function_words")
    votes = {r.row.doc_id: r.votes[at] for r in voted.collect()}
    assert votes == {0: quality.ABSTAIN, 1: quality.ABSTAIN, 2: quality.ABSTAIN, 3: quality.REJECT, 4: quality.REJECT}
