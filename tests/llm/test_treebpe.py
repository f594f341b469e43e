"""Byte-level BPE by a segment tree against the tiktoken library and a plain merge loop."""

import base64
import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import treebpe as B

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TREE = B.TreeBpe.load(PATH)

TEXTS = [
    "", " ", "  \n\n  x", "The quick brown fox's don't we'll I'M", "café naïve über straße", "中文字符串 日本語", "12345678901234567890 3.14", "<|endoftext|> is text",
    "مرحبا नमस्ते", "\U0001f600\U0001f468‍\U0001f469‍\U0001f467 ok", "a" * 63, "a" * 64, "a" * 65, "ab" * 700, "x y z\u0085q​", "\t\ttab\r\n", "====----====" * 40, "\0\0 nul \0",
]


def plain(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    if word in ranks:
        return [ranks[word]]
    parts = [word[i : i + 1] for i in range(len(word))]
    while True:
        found = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
        if not found:
            return [ranks[p] for p in parts]
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_equals_the_library():
    ids, ends = TREE.encode_batch(TEXTS)
    cut = [0, *ends.tolist()]
    for t, a, b in zip(TEXTS, cut, cut[1:], strict=False):
        assert ids[a:b].tolist() == LIBRARY.encode_ordinary(t), t
    assert TREE.decode_batch(ids, ends) == [t.encode() for t in TEXTS]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aab ' sé中\n\t1.\U0001f600") | st.characters(exclude_categories=("Cs",)), max_size=150), max_size=6))
def test_random_texts_equal_the_library(texts):
    ids, ends = TREE.encode_batch(texts)
    assert ids.tolist() == [i for t in texts for i in LIBRARY.encode_ordinary(t)]
    assert TREE.decode_batch(ids, ends) == [t.encode() for t in texts]


def test_long_runs_equal_the_library():
    rng = random.Random(5)
    for n in (100, 3000, 20_000):
        for letters in ("a", "ab", "abcdefghijklmnopqrstuvwxyz", "中文字"):
            word = "".join(rng.choice(letters) for _ in range(n))
            assert TREE.encode(word) == LIBRARY.encode_ordinary(word)


@pytest.mark.parametrize("seed", range(6))
def test_trees_of_both_forms_equal_the_plain_loop(seed):
    """Vocabularies in which many pairs tie or overlap, and some tokens are out of the merges' reach."""
    rng = random.Random(seed)
    tokens = {bytes([c]) for c in b"abc"} | {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 6))) for _ in range(25)}
    order = sorted(tokens)
    rng.shuffle(order)
    ranks = {t: 3 * i for i, t in enumerate(order)}  # with gaps
    tree = B.TreeBpe(ranks)
    words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 40))) for _ in range(80)]
    got, starts, counts = tree.merge_words(words)
    for w, s, c in zip(words, starts, counts, strict=True):
        assert got[s : s + c].tolist() == plain(w, ranks)
        if w not in ranks:
            assert tree.merge_long(w).tolist() == plain(w, ranks)


def test_rows_are_cut_into_blocks(monkeypatch):
    whole = TREE.encode_batch(TEXTS)
    monkeypatch.setattr(B, "CELLS", 64)
    cut = TREE.encode_batch(TEXTS)
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))


def test_a_missing_byte_is_an_error():
    with pytest.raises(ValueError, match="lacks a single byte"):
        B.TreeBpe({b"a": 0, b"b": 1}).encode("abz")


def digests(text):
    ids = LIBRARY.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_equals_the_library(spark, documents, monkeypatch):
    texts = [*TEXTS, None, TEXTS[3], "word " * 30_000]
    got = sorted(tuple(r) for r in B.op11_byte_bpe(spark, documents(texts)).collect())
    assert got == [(i, *digests(t)) for i, t in enumerate(texts)]


def test_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([("k", "a b", 1, b"")], "doc_id string, text string, n_tokens long, ids binary")
    row = B.encode(docs, PATH).first()
    assert row.doc_id == "k" and list(struct.unpack("<2I", row.ids)) == LIBRARY.encode_ordinary("a b") and bytes(row.decoded) == b"a b"
    assert B.encode(docs.where("false"), PATH).collect() == []
