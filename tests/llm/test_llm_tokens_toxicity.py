"""Token counts against the library; nearest examples against all of them, held-out accuracy."""

import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers as tokenizers_
from tokenizers import Tokenizer
from wayfare.llm import queries, token_counts, toxicity

PATH = tokenizers_.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, n_tokens string, run string"


def test_token_counts(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "FREQUENT", 6)  # nearly all runs take the join
    library = Tokenizer.from_file(PATH)
    rng = random.Random(1)
    parts = ["the", "The", "don't", "word.", "word,", "a<|endoftext|>b", "<|startoftext|>", "É.", "é", "́x", "ΣΑΣ.", "İ.", "漢字。", "1.5", "abc1", "'S.", "x\x1cy", "a b", "a　b", ".", "...", "ﬁ.", "😀!"]
    texts = [rng.choice([" ", "\n", "  ", "\x0b", "\t"]).join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(300)]
    texts += [None, "", " ", "x" * 20000, "long text " * 30000, texts[0], texts[0]]
    data = [(k, t, "clash", "clash") for k, t in enumerate(texts)] + [(None, "a b", "", ""), (0, texts[0], "clash", "clash")]
    got = token_counts.count_tokens(spark.createDataFrame(data, SCHEMA), PATH).collect()
    assert len(got) == len(data)
    for r in got:
        text = r.row.text or ""
        assert r.n_tokens == len(library.encode(text, add_special_tokens=False).ids), repr(text)[:200]
        assert r.n_bytes == len(text.encode())
    assert token_counts.count_tokens(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_nearest_are_exact():
    rng = random.Random(3)
    terms = [(f"t{k}", rng.randint(5, 900)) for k in range(60)]
    vectorizer = toxicity.Vectorizer.of(terms, 1000)
    examples = {}
    for _ in range(900):
        own = {rng.choice((0, rng.randrange(1, 61))): 1 << rng.randrange(5) for _ in range(rng.randint(1, 6))}
        examples[tuple(sorted(own.items()))] = (rng.randint(1, 4), 0)
    index = toxicity.BlockMaxIndex(vectorizer, [(c, n, b) for c, (n, b) in examples.items()])
    dense = np.zeros((len(index.examples), 61))
    for row, (counts, _, _) in enumerate(index.examples):
        t, w = vectorizer.vector(counts)
        dense[row, t] = w
    for counts, _, _ in rng.sample(index.examples, 100) + [(((0, 4),), 1, 0), (((59, 1), (60, 1)), 1, 0)]:
        t, w = vectorizer.vector(counts)
        query = np.zeros(61)
        query[t] = w
        cosine = dense @ query
        order = np.argsort(-cosine, kind="stable")
        cut = np.flatnonzero(np.cumsum(index.n[order]) >= 10)[0]
        want = {k for k in range(len(cosine)) if cosine[k] >= cosine[order[cut]] - 1e-9 and cosine[k] > 0}
        ids, scores = index.nearest(t, w, 10)
        assert set(ids.tolist()) == want
        assert np.allclose(scores, cosine[ids]) and (np.diff(scores) <= 1e-12).all()
    assert len(index.nearest(np.zeros(0, int), np.zeros(0), 5)[0]) == 0


def test_calibration_rises():
    rng = np.random.default_rng(1)
    raw = rng.random(500).round(2)
    xs, ys = toxicity._rising(raw, (rng.random(500) < raw).astype(float))
    assert (np.diff(xs) > 0).all() and (np.diff(ys) >= 0).all() and 0 <= ys[0] <= ys[-1] <= 1


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.op10_toxicity(spark, sf_dir).toPandas()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    both = pd.read_parquet(f"{sf_dir}/labels.parquet").merge(got[got.held_out], on="doc_id")
    assert len(both) > 60 and (both.toxic == both.predicted).mean() > 0.93


def test_scores_of_odd_texts(spark):
    schema = "doc_id long, text string, score string, evidence string"
    rng = random.Random(2)
    clean = [" ".join(rng.choices(["house", "river", "tree", "road", "lake"], k=20)) for _ in range(200)]
    bad = [t + " idiot moron" for t in clean[:60]]
    labelled = spark.createDataFrame([(t, 0) for t in clean] + [(t, 1) for t in bad] + [(None, 0), ("", 1), ("x", None)], "text string, label int")
    model = toxicity.fit(labelled)
    texts = [None, "", "123 !!", clean[0], bad[0], "IDIOT!!", "moron, idiot. " * 20000, "you idiot", "unknown words only"]
    data = [(k, t, "clash", "clash") for k, t in enumerate(texts)] * 2 + [(None, bad[0], "", "")]
    got = toxicity.scored(spark.createDataFrame(data, schema), model).collect()
    assert len(got) == len(data)
    score = {r.row.doc_id: r.score for r in got}
    assert all(0 <= s <= 1 for s in score.values())
    assert min(score[k] for k in (4, 5, 6, 7)) > 0.5 > max(score[k] for k in (0, 1, 2, 3, 8))
    assert score[None] == score[4] and {r.row.score for r in got} == {"clash", ""}
    assert next(r for r in got if r.row.doc_id == 7).evidence[0].toxic > 0
    assert toxicity.scored(spark.createDataFrame([], schema), model).collect() == []


def test_a_document_with_two_labels_has_the_larger(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "doc_id long, text string")
    data = [(1, 0), (1, 1), (2, 1), (2, 0), (3, 0), (3, 0), (3, None), (None, 1)]
    for rows in (data, data[::-1]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        got = toxicity.sampled(docs, labels, "doc_id", "text", "toxic").collect()
        assert sorted((r.text, r.label) for r in got) == [("a", 1), ("b", 1), ("c", 0)]
