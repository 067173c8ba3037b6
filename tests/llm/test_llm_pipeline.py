"""The pipeline, each stage against plain Python on what the stage before kept."""

from collections import Counter

import corpus_pipeline
import public_tokenizers as tokenizers_
import pytest
import tiktoken
from oracle_check import connect, difference
from pyspark.sql import functions as F
from test_llm_ngram import plain_components
from wayfare.llm import bpe, mixing, pii, quality
from wayfare.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES
from wayfare.llm.text import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NAMES = [name for name, _ in corpus_pipeline.STAGES]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Rows before the first stage and after each, over documents and some odd rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = docs.orderBy(F.desc(F.length("text"))).first().text
    mail = text + " write to jo.doe@mail.example.com now"
    odd = [(None, None, None, None, None), (-1, "", "en", None, 0), (-2, None, "en", "src1", None), (-3, text, "en", "src1", 1), (-3, text, "en", "src1", 1), (-4, mail, None, None, None)]
    docs = stored(docs.union(spark.createDataFrame(odd, docs.schema)), "documents")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], sf_dir), name))
    return frames


def test_shape(stages):
    assert NAMES == ["quality_rules", "near_duplicates", "surrogates", "mix_sources", "encode_bytes"]
    assert all(frame.columns == COLUMNS for frame in stages[:-1])


def test_quality_rules(stages):
    verdict = {(r.row.doc_id, r.row.text): r.kept for r in quality.judged(stages[0]).collect()}
    want = [(r.doc_id, r.text) for r in stages[0].collect() if verdict[r.doc_id, r.text]]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.text)) for r in stages[1].collect())
    assert all(len(r.text.split()) >= 50 for r in stages[1].collect())


def test_near_duplicates(stages):
    before = [(r.doc_id, r.text) for r in stages[1].collect()]
    heads = {i for i, _, c in plain_components(before, 5, 80, 100) if i == c}
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(heads)
    assert len(heads) < len(before)


def test_surrogates(stages):
    before = {r.doc_id: r for r in stages[2].collect()}
    after = {r.doc_id: r for r in stages[3].collect()}
    assert before.keys() == after.keys()
    for i, r in before.items():
        clean, found = pii.replaced(r.text, corpus_pipeline.SURROGATE_KEY, {})
        assert after[i].text == clean and after[i].n_chars == len(clean)
        assert found or after[i].text == r.text
        assert (after[i].lang, after[i].source) == (r.lang, r.source)
    assert not any("jo.doe@" in r.text for r in after.values())


def test_mix_sources(stages):
    want = Counter()
    for r in mixing.mix(stages[3]).collect():
        want[r.doc_id] += r.taken // r.size if r.size else 0
    got = Counter(r.doc_id for r in stages[4].collect())
    assert got == +want
    assert max(got.values()) <= 3


def test_encode_bytes(stages):
    ranks = bpe.load_ranks(tokenizers_.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=tokenizers_.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    rows = stages[5].collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in stages[4].collect())
    for r in rows:
        assert list(r.ids) == library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(r.ids) and r.round_trip


def test_empty_table(spark, sf_dir, stages):
    docs = stages[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "empty")
    assert docs.collect() == []


def test_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES if name.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in LLM_QUERIES
    assert corpus_pipeline.ORACLE_SQL is None and set(LLM_ORACLE_SQL) <= set(LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(LLM_QUERIES[name](spark, sf_dir), connect(sf_dir), LLM_ORACLE_SQL[name]) is None
