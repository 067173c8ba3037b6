"""Token alignment against a plain version that tokenizes whole texts and walks over their bytes."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers as tokenizers_
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer
from wayfare.llm import queries, token_alignment
from wayfare.llm.text import read_table

PATHS = [tokenizers_.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
SCHEMA = "doc_id long, text string, n_a string, links string, at string"
PARTS = [
    "the", "The", "don't", "word.", "word,", "a<|endoftext|>b", "<s>", "É.", "é", "é", "漢字。", "1.5", "'s.",
    "x\x1cy", "a\xa0b", ".", "...", "ﬁ.", "😀!", "▁", "a▁b", "<0x0A>", "\t", "\r\n", "x\r", ");", "etc.", "com.", "𐍈",
    "\x00", "\x85", " ", "ß.", "᠎", "ñ,", "http://a.b/c?d=e", "aaaa" * 30, "日本" * 20, "👨‍👩", "͸.",
]
SEPARATORS = [[" "], [" ", "\n"], [" ", "\n", "  ", "\n\n", "\t", " \n", "\n ", "", "\x0b"]]


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=PATHS[1])
        self.entries = {k: entry for entry, k in self.a.get_vocab().items()}
        self.alphabet = token_alignment.byte_alphabet()

    def piece(self, k):
        piece = self.b.id_to_piece(k)
        byte = re.fullmatch("<0x(..)>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def __call__(self, text):
        """Groups as text, numbers of tokens and groups, and how often each pair is linked."""
        nothing = "", 0, 0, 0, Counter()
        if not text:
            return nothing
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        ids = {"a": a, "b": b}
        tokens = {"a": [bytes(self.alphabet[c] for c in self.entries[k]) for k in a], "b": [self.piece(k) for k in b]}
        ends = {}
        for side, own in tokens.items():
            if b"".join(own) != (" " + text).encode():
                return nothing
            total, ends[side] = 0, []
            for token in own:
                total += len(token)
                ends[side].append(total)
        groups, links, start = [], Counter(), 0
        for end in sorted(set(ends["a"]) & set(ends["b"])):
            own = {s: [k for k, e in zip(ids[s], ends[s]) if start < e <= end] for s in "ab"} if len(text) < 500 else {
                s: ids[s][_place(ends[s], start) : _place(ends[s], end)] for s in "ab"
            }
            groups.append("|".join(",".join(map(str, own[s])) for s in "ab"))
            links.update((x, y) for x in own["a"] for y in own["b"])
            start = end
        return ";".join(groups), len(a), len(b), len(groups), links


def _place(ends, end):
    import bisect

    return bisect.bisect_right(ends, end)


@pytest.fixture(scope="module")
def plain():
    return Plain()


def random_texts(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        separators = rng.choice(SEPARATORS)
        yield "".join(rng.choice(PARTS) + rng.choice(separators) for _ in range(rng.randint(0, 12)))


def differences(aligner, plain, texts):
    found = aligner.documents(texts)
    for k, text in enumerate(texts):
        groups, n_a, n_b, n_groups, links = plain(text)
        want = [groups, n_a, n_b, n_groups, sum(links.values()), sorted((*pair, n) for pair, n in links.items())]
        got = [found[c][k].as_py() for c in ("groups", "n_a", "n_b", "n_groups", "n_links", "links")]
        got[-1] = [(x["a"], x["b"], x["n"]) for x in got[-1]]
        if got != want:
            yield text, got, want


@pytest.mark.parametrize("separable, wide", [(True, 1 << 16), (True, 2), (False, 1 << 16)])
def test_units_align_like_whole_texts(plain, monkeypatch, separable, wide):
    monkeypatch.setattr(token_alignment, "WIDE", wide)
    aligner = token_alignment.Aligner(*PATHS, most=300)  # forgets in between
    assert aligner.cuts
    aligner.cuts = separable
    aligner.forget()
    for seed in range(4):
        texts = [*random_texts(250, seed), None, "", " ", "\n", "  ", " a", "\na", "a\n", "a ", "x" * 3000]
        assert list(differences(aligner, plain, texts)) == []


def test_spans_place_tokens_and_bytes_refine_them():
    aligner = token_alignment.Aligner(*PATHS)
    # Three tokens of A for one character, four bytes of B for another, and plain ones around them.
    for text in ("日本 x", "𐍈y", "é日😀", "a𐍈𐍈b"):
        for side, unit in ((aligner.a, " " + text), (aligner.b, " " + text)):
            ids, spans = next(side.read([unit]))
            at = [len(unit[:k].encode()) for k in range(len(unit) + 1)]
            lengths = [len(side.bytes[k]) for k in ids]
            own = aligner.len_a if side is aligner.a else aligner.len_b
            ends = token_alignment.byte_ends(ids, spans, own, token_alignment.np.array(at))
            assert ends.tolist() == [sum(lengths[: k + 1]) for k in range(len(ids))], text


def expected(rows, plain):
    """doc_id to its row, by plain counts over all rows."""
    aligned = [(doc_id, plain(text)) for doc_id, text in rows]
    documents = Counter(pair for _, found in aligned for pair in found[4])
    best = Counter()
    for (a, _), n in documents.items():
        best[a] = max(best[a], n)
    for doc_id, (groups, n_a, n_b, n_groups, links) in aligned:
        n_best = sum(n for pair, n in links.items() if documents[pair] == best[pair[0]])
        count_sum = sum(n * documents[pair] for pair, n in links.items())
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        yield doc_id, n_a, n_b, n_groups, sum(links.values()), n_best, count_sum, digest


@pytest.mark.parametrize("rows", [0, 40, 200_000])  # of the table of frequent pairs
def test_counts_of_links(spark, plain, rows):
    texts = [*random_texts(120, 9), None, "", "the word.", "the word.", "▁", "long text, " * 5000]
    data = [(k, t, "clash", "clash", "clash") for k, t in enumerate(texts)] + [(None, "the", "", "", ""), (0, texts[0], "", "", "")]
    found = token_alignment.align(spark.createDataFrame(data, SCHEMA), *PATHS)
    flat = found.selectExpr("row.doc_id", "groups", "n_a", "n_b", "n_groups", "n_links", "links")
    got = token_alignment.counted(flat, rows).collect()
    digest = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    rows_ = sorted(((*[r[c] for c in names], digest(r.groups)) for r in got), key=repr)
    assert rows_ == sorted(expected([(d[0], d[1]) for d in data], plain), key=repr)


def test_other_columns_and_empty_table(spark):
    data = [(1, "a b", "clash", "clash", "clash")]
    row = token_alignment.align(spark.createDataFrame(data, SCHEMA), *PATHS).collect()[0]
    assert tuple(row.row) == data[0] and row.n_a == 2
    empty = token_alignment.align(spark.createDataFrame([], SCHEMA), *PATHS)
    assert token_alignment.counted(empty.drop("row")).collect() == []


def test_query(spark, sf_dir, plain):
    got = queries.op13_token_alignment(spark, sf_dir)
    assert got.columns[:2] == ["doc_id", "n_a"]
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == sorted(expected(docs, plain))
