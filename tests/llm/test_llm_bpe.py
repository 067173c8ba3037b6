"""Byte-level BPE against the public library; exact round trip."""

import codecs
import random

import pyarrow as pa
import pytest
import public_tokenizers as tokenizers_
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from wayfare.llm import bpe

PATH = tokenizers_.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=tokenizers_.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = bpe.Encoder(RANKS, tokenizers_.PATTERN)
MACHINE = bpe.Utf8Machine({rank: token for token, rank in RANKS.items()})
# Letters that the pattern's library and the other one know alike.
LETTERS = st.characters(max_codepoint=0x2FF) | st.sampled_from("漢字かな가나жщ😀👍🏽ﬁ́ 　\x1c\x85")


def check(texts):
    ids, decoded = ENCODER.batch(pa.array(texts, pa.string()), MACHINE)
    got = ids.to_pylist()
    assert decoded == [t or "" for t in texts]
    for text, ids in zip(texts, got):
        assert ids == LIBRARY.encode_ordinary(text or ""), repr(text)
        assert MACHINE(ids) == (text or "")


def test_random_texts():
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "a", "b", "the", "ing", "'s", "'ll", "1", "23", "é", "ß", "漢", "😀", "!", "...", "\t", " ", "aaaa", "\x1c", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(4000)]
    texts += ["".join(rng.choices("aabcdetio ", k=rng.randint(1, 40))) for _ in range(3000)]
    texts += [rng.choice(["a", "ab", "aab", " ", "\n", "éa", "="]) * rng.randint(1, 400) for _ in range(100)]
    check([None, "", " ", "\n", *texts])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(LETTERS, max_size=60), max_size=5))
def test_any_texts(texts):
    check(texts)


def test_a_vocabulary_that_reaches_far():
    """Long tokens that only the last byte decides, and tokens that merging never gives."""
    ranks = {bytes([b]): b for b in range(256)}
    for token in (b"ab", b"cd", b"abcd", b"abcdab", b"bc", b"aa", b"aaa", b"aaaaa", b"dab", b"zq"):
        ranks[token] = len(ranks)
    other = tiktoken.Encoding("far", pat_str=tokenizers_.PATTERN, mergeable_ranks=ranks, special_tokens={})
    transducer = bpe.Transducer(ranks)
    rng = random.Random(1)
    for _ in range(3000):
        word = "".join(rng.choices("abcdz", k=rng.randint(1, 14)))
        assert transducer.encode(word.encode()) == other.encode_ordinary(word), word


def test_states_are_dropped_and_made_anew(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 50)
    transducer = bpe.Transducer(RANKS)
    rng = random.Random(2)
    for _ in range(300):
        word = "".join(rng.choices("etaoins", k=rng.randint(1, 12)))
        assert transducer.encode(word.encode()) == LIBRARY.encode_ordinary(word)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40))
def test_decoding_any_bytes(data):
    machine = bpe.Utf8Machine({b: bytes([b]) for b in range(256)})
    text = machine(list(data))
    try:
        assert text == data.decode()
    except UnicodeDecodeError:
        assert codecs.decode(data, "utf-8", "ignore").replace("�", "") == text.replace("�", "")


def test_missing_bytes_are_refused():
    with pytest.raises(ValueError):
        bpe.Transducer({b"a": 0})


def test_table(spark):
    schema = "doc_id long, text string, ids string, decoded string"
    long = "wörter und mehr " * 40000
    data = [(1, None, "x", "y"), (2, "", "x", "y"), (2, "", "x", "y"), (3, long, None, None), (None, "a  b", "", "")]
    docs = spark.createDataFrame(data, schema)
    coded = bpe.encode(docs, PATH, tokenizers_.PATTERN)
    apart = bpe.decode(coded, PATH).collect()
    together = bpe.encode(docs, PATH, tokenizers_.PATTERN, back=True).collect()
    assert apart == together
    for r in apart:
        assert list(r.ids) == LIBRARY.encode_ordinary(r.row.text or "")
        assert r.decoded == (r.row.text or "") and r.row.ids in ("x", None, "")
    empty = bpe.encode(spark.createDataFrame([], schema), PATH, tokenizers_.PATTERN, back=True)
    assert empty.collect() == []
