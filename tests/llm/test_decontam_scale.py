"""Contamination of repetitive and long texts, windows that many items share, and the plan for large benchmarks."""

import random
import time

import pytest
from test_text_ops import brute_hits

from tidemark.llm import decontam

ITEMS = "item_id long, text string"


def told(spark, path):
    return {x["doc_id"]: tuple(x)[1:] for x in decontam.op9_decontaminate(spark, path).collect()}


@pytest.mark.parametrize("most", [500_000, 0])
def test_repetitive_texts_equal_brute_force(spark, documents, monkeypatch, most):
    """Equal words, periods, windows of several items; with all sides broadcast, and with none."""
    monkeypatch.setattr(decontam, "MAX_BROADCAST_WORDS", most)
    r = random.Random(2)
    items = [(1, "ab " * 13), (2, "ab " * 40), (3, "x y " * 12), (4, "one two three"), (5, " ".join(r.choice("pq") for _ in range(60))), (6, "ab " * 13 + "end"), (7, "solo"), (8, "ab " * 12)]
    texts = ["ab " * n for n in (5, 12, 13, 14, 100)] + ["x y " * 30, "y " + "x y " * 9, "ab " * 20 + "end solo ab", " ".join(r.choice("pq") for _ in range(400)), "pre " + items[4][1] + " post", "one two three one two three two", "solo " * 9, ""]
    path = documents(texts, benchmark=(items, ITEMS))
    assert told(spark, path) == {i: brute_hits(t, items) for i, t in enumerate(texts)}


def test_a_long_repetitive_text_takes_time_in_proportion(spark, documents):
    path = documents(["ab " * 100_000, "x y " * 50_000, "ab " * 12 + "z"], benchmark=([(1, "ab " * 13), (2, "x y " * 20)], ITEMS))
    began = time.time()
    got = told(spark, path)
    assert [(g[0], g[1], g[2]) for _, g in sorted(got.items())] == [(100_000, 100_000, 1), (100_000, 100_000, 1), (13, 0, 0)]
    assert time.time() - began < 120
