"""Importance resampling against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import resample as R


def brute(docs, target, n, buckets, seed, percent, least):
    """docs: list of (id, text). Rows of (id, n_features, weight, score, rank)."""

    def feats(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
        return w, [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for i in range(len(w)) for k in range(1, n + 1) if i + k <= len(w)]

    rows = [(i, *feats(t)) for i, t in docs]
    s, t = Counter(b for *_, f in rows for b in f), Counter(b for x in target for b in feats(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (s_all + float(buckets)) / ((s[b] + 1.0) * (t_all + float(buckets))))) for b in range(buckets)}
    out = []
    for i, w, f in rows:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= least])
    ranked = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    rank = {id(r): k + 1 for k, r in enumerate(ranked) if k < percent * len(ranked) // 100}
    return sorted(([*r[:4], rank.get(id(r))] for r in out), key=repr)


TEXTS = ["", None, "one", "A bé c-3 A bé", "x " * 40, "x " * 40, "中文 Word\tword " * 9, "!!! ..."] + [" ".join(f"w{(i * j) % 13}" for j in range(5 + 3 * i)) for i in range(30)]


@pytest.mark.parametrize("n", [1, 3])
def test_equals_brute_force(spark, n):
    docs = [*enumerate(TEXTS), (None, "x y " * 20), (4, "x " * 40), (4, "z " * 40)]
    frame = spark.createDataFrame([(i, t, "clash", 1.0) for i, t in docs], "doc_id long, text string, id string, score double").repartition(3)
    target = spark.createDataFrame([("w1 w2 w3 w1",), (None,), ("bé c",)], "text string")
    for percent in (10, 50):
        got = R.resample(frame, target, n, 97, 7, percent, 20)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert sorted((list(r) for r in got.collect()), key=repr) == brute(docs, ["w1 w2 w3 w1", None, "bé c"], n, 97, 7, percent, 20)


def test_query_equals_brute_force(spark, documents):
    texts = TEXTS * 3
    sf = documents(texts, benchmark=([(1, "w1 w2 A"), (2, None)], "item_id long, text string"))
    got = sorted((list(r) for r in R.op13_resample(spark, sf).collect()), key=repr)
    assert got == brute(list(enumerate(texts)), ["w1 w2 A", None], 1, 10_000, 2024, 10, 20)


def test_empty_tables(spark, documents):
    sf = documents([], [], benchmark=([], "item_id long, text string"))
    assert R.op13_resample(spark, sf).collect() == []


@pytest.mark.parametrize("n", [1, 2, 4])
def test_slices_change_nothing(n):
    text = "Ab, cd efé gh " * 5000 + "z" * 3000 + " q"
    whole, cut = R.features(text, n, 50, 1 << 30), R.features(text, n, 50, 100)
    assert whole[:2] == cut[:2] and all((a == b).all() for a, b in zip(whole[2:], cut[2:], strict=True))
    assert whole[1] == sum(whole[0] - k for k in range(n)) == whole[3].sum()
