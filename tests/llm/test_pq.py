"""Vector codes against brute force in Python integers."""

import hashlib
import math
import random
import struct

import numpy as np
import pytest

from tidemark.llm import pq as P

SCHEMA = "vec_id long, embedding array<float>, label int"


def f32(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [(i, [math.floor(scale * f32(x)) for x in v], y) for i, v, y in rows if v and all(x is not None and math.isfinite(x) for x in v) and len(v) % parts == 0]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not order:
        return [], []
    n = len(order[0][1])
    kept, order = [r for r in kept if len(r[1]) == n], [r for r in order if len(r[1]) == n]
    d = n // parts
    cut = lambda v, p: v[p * d : (p + 1) * d]
    books = [[cut(r[1], p) for r in order[:entries]] for p in range(parts)]

    def near(x, b):
        return min((sum((a - c) ** 2 for a, c in zip(x, e, strict=True)), k) for k, e in enumerate(b))

    for _ in range(rounds):
        for p in range(parts):
            got = {}
            for r in kept:
                got.setdefault(near(cut(r[1], p), books[p])[1], []).append(cut(r[1], p))
            for k, xs in got.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    out = []
    for i, v, y in kept:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append([i, "".join(f"{k:02x}" for _, k in found), sum(e for e, _ in found), y])
    sums = {}
    for _, _, e, y in out:
        sums[y] = sums.get(y, 0) + e
    fit = lambda e: e if e < 2**63 else None
    for r in out:
        whole = [e for _, _, e, y in out if y == r[3]]
        r[3] = sums[r[3]] if all(e < 2**63 for e in whole) and sums[r[3]] < 2**63 else None
        r[2] = fit(r[2])
    return sorted(map(tuple, out), key=repr), books


def run(spark, rows, **more):
    coded, books = P.compress(spark.createDataFrame(rows, SCHEMA).repartition(3), **more)
    got = sorted(((r.id, bytes(r.codes).hex(), r.error, r.label_error) for r in P.label_errors(coded).collect()), key=repr)
    return got, books


def vectors(rng, n, d, spread=1.0):
    return [[rng.gauss(0, spread) for _ in range(d)] for _ in range(n)]


@pytest.mark.parametrize("entries", [4, 256])
def test_equals_brute_force(spark, entries):
    rng = random.Random(entries)
    rows = [(i, v, rng.choice([None, 0, 1, 2])) for i, v in enumerate(vectors(rng, 120, 8))]
    rows += [(5, rows[7][1], 1)] * 3 + [(None, v, 1) for v in vectors(rng, 3, 8)] + [(900, None, 1), (901, [], 1), (902, [1.0, None] * 4, 1), (903, [float("nan")] * 8, 1), (904, [float("inf")] + [0.0] * 7, 0), (905, [1.0] * 7, 0), (906, [1.0] * 12, 0)]
    want, books = brute(rows, entries=entries)
    got, found = run(spark, rows, entries=entries)
    assert found == books and got == want


def test_ties_go_to_the_lower_index(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(-1, 1)) for _ in range(4)], 0) for i in range(90)]
    want, books = brute(rows, entries=7)
    assert run(spark, rows, entries=7) == (want, books)


def test_components_of_any_finite_float_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, [x * 10.0 ** rng.choice([0, 3, 6, 12, 30, 38]) for x in (rng.uniform(-1, 1) for _ in range(4))], i % 3) for i in range(40)] + [(i, v, 5) for i, v in enumerate(vectors(rng, 20, 4), 40)]
    want, books = brute(rows, entries=5)
    got, found = run(spark, rows, entries=5)
    assert found == books and got == want


@pytest.mark.parametrize("spread", [1, 30, 3000, 2.0**25])
def test_screening_is_exact(spread):
    rng = np.random.default_rng(int(spread))
    book = np.floor(rng.normal(0, spread, (256, 16))).astype(np.int64)
    book[40:60] = book[20:40]  # equal entries
    book[60:80] = book[20:40] + (np.arange(16) == 3)  # next to each other
    rows = np.concatenate([np.floor(rng.normal(0, spread, (500, 16))).astype(np.int64), book, (book[:100] + book[100:200]) // 2])
    rows, book = np.clip(rows, 1 - P.WIDE, P.WIDE - 1), np.clip(book, 1 - P.WIDE, P.WIDE - 1)
    index, error = P.Codebook(book.tolist()).nearest(rows)
    exact = ((rows[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (index == exact.argmin(axis=1)).all() and (error == exact.min(axis=1)).all()


def test_query_and_reconstruction(spark, frame):
    rng = random.Random(9)
    rows = [(i * 3, v, i % 2 if i % 5 else None) for i, v in enumerate(vectors(rng, 60, 16, 0.2))]
    sf = frame(embeddings=(rows, SCHEMA))
    want, books = brute(rows)
    got = P.op12_vector_codes(spark, sf).collect()
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=repr) == want
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    assert {r.codebooks_sha256 for r in got} == {digest}
    coded, found = P.compress(spark.createDataFrame(rows, SCHEMA), entries=8)
    back = {r.id: r.vector for r in P.reconstruct(coded, found).collect()}
    errors = {r.id: r.error for r in coded.collect()}
    for i, v, _ in rows:
        away = sum((math.floor(1024 * f32(a)) + 0.5 - 1024 * b) ** 2 for a, b in zip(v, back[i], strict=True))
        assert math.isclose(away, errors[i], rel_tol=1e-6, abs_tol=1e-6)


def test_empty_tables(spark, frame):
    for rows in ([], [(1, None, 1)]):
        assert run(spark, rows) == ([], [])
    assert P.op12_vector_codes(spark, frame(embeddings=([], SCHEMA))).collect() == []
