"""Families of lines that share a stretch and have the same letters, which once met pairwise."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tests.llm.test_text_ops import brute_lines
from tidemark.llm import linededup

LATIN = "GET /index/{} 200 OK from the front end of a shop"
GREEK = "Λήψη σελίδας {} χωρίς σφάλμα από το κατάστημα"


def changed(rng, line):
    """The line after one or two edits, of any kind."""
    for _ in range(rng.randint(1, 2)):
        i, c = rng.randrange(len(line)), rng.choice("0123456789xλ𝒳")
        line = rng.choice([line[:i] + c + line[i + 1 :], line[:i] + line[i + 1 :], line[:i] + c + line[i:]])
    return line


@pytest.mark.parametrize("family", [1, 4, 256])
def test_families_against_brute_force(spark, documents, monkeypatch, family):
    monkeypatch.setattr(linededup, "MAX_FAMILY", family)
    rng = random.Random(3)
    lines = [form.format(f"{rng.randrange(10**14):014}") for form in (LATIN, GREEK) for _ in range(40)]
    lines += [changed(rng, rng.choice(lines)) for _ in range(60)]
    rng.shuffle(lines)
    texts = ["\n".join(lines[i : i + 7]) for i in range(0, len(lines), 7)]
    docs = spark.read.parquet(documents(texts) + "/documents.parquet")
    assert {x["doc_id"]: x["text"] for x in linededup.dedup_lines(docs).collect()} == dict(enumerate(brute_lines(texts)))


@pytest.mark.parametrize("form", [LATIN, GREEK])
def test_many_lines_that_differ_in_digits(spark, documents, form):
    rng = random.Random(5)
    lines = [form.format(f"{n:014}") for n in rng.sample(range(10**14), 30_000)]
    texts = ["\n".join(lines[i : i + 1000]) for i in range(0, len(lines), 1000)] + [changed(rng, lines[17])]
    docs = spark.read.parquet(documents(texts) + "/documents.parquet")
    began = time.time()
    got = {x["doc_id"]: x["n_removed"] for x in linededup.dedup_lines(docs).collect()}
    assert got == {i: int(i == len(texts) - 1) for i in range(len(texts))}
    assert time.time() - began < 120


def test_a_family_of_copies_of_its_leader_is_done_after_the_first_round(spark, documents, monkeypatch):
    rows = []
    sub_keys = linededup.sub_keys

    def counted(*a):
        rows.append(sub_keys(*a).count())
        return sub_keys(*a)

    monkeypatch.setattr(linededup, "sub_keys", counted)
    line = LATIN.format("0" * 14)
    texts = [line] + [line[:i] + "x" + line[i + 1 :] for i in range(len(line))]
    docs = spark.read.parquet(documents(texts) + "/documents.parquet")
    assert [x["n_removed"] for x in linededup.dedup_lines(docs).orderBy("doc_id").collect()] == [0] + [1] * len(line)
    assert sum(rows) == 0


def test_segments_are_cut_alike_by_bytes_and_characters(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(letters) for _ in range(n)) for letters in ("abc d", "aλ𝒳 ") for n in (30, 31, 32, 33, 50, 64)]
    lines = spark.createDataFrame([(i, (i, i, 0), t, len(t)) for i, t in enumerate(texts)], "lid long, pos struct<id: long, h: long, n: int>, line string, len int")
    places = linededup.probes()
    assert len(places) == 12
    plain = {}
    for lid, t in enumerate(texts):
        for shorter, i, shift in places:
            n = len(t) - shorter
            base, more = divmod(n, 3)
            sizes = [base + (k >= 3 - more) for k in range(3)]
            at = sum(sizes[:i]) + shift
            if n >= linededup.MIN_CHARS:
                plain.setdefault(lid, []).append((n, i, t[at : at + sizes[i]], shorter == 0 == shift))
    want = [(~lid if own else lid, n, i, s) for lid, keys in plain.items() for n, i, s, own in keys]
    want = spark.createDataFrame(want, "who long, n int, i int, s string").selectExpr("who", "xxhash64(n, i, s) AS key")
    assert sorted(map(tuple, linededup.probe_rows(lines).collect())) == sorted(map(tuple, want.collect()))
    own = want.where("who < 0").selectExpr("~who AS lid", "~who AS id", "key")
    assert sorted(map(tuple, linededup.index_rows(lines).collect())) == sorted(map(tuple, own.collect()))


def test_pairs_of_lines_are_verified_in_little_time(spark):
    rng = random.Random(9)
    pairs = []
    for _ in range(40_000):
        line = "".join(rng.choices("abcdefgh λ", k=120))
        pairs.append((line, line[:50] + "x" + line[51:70] + line[71:] + "y" * rng.randrange(2)))
    rows = spark.createDataFrame(pairs, "a string, b string").repartition(4).cache()
    assert rows.count() == len(pairs)
    began = time.time()
    near = linededup.near(F.col("a"), F.col("b"), F.length("a"), F.length("b"))
    got = rows.select(near.alias("n"), (F.levenshtein("a", "b") <= 2).alias("w")).groupBy("n", "w").count().collect()
    assert {(x["n"], x["w"]) for x in got} == {(True, True), (False, False)}
    assert time.time() - began < 8


def test_both_ways_of_verifying_agree(spark):
    rng = random.Random(11)
    pairs = []
    for _ in range(400):
        line = other = "".join(rng.choices("ab λ𝒳", k=rng.randint(30, 90)))
        for _ in range(rng.randint(0, 2)):
            other = changed(rng, other)
        pairs.append((line, other))
    rows = spark.createDataFrame(pairs, "a string, b string").where("abs(length(a) - length(b)) <= 2")
    way = lambda f: f(F.col("a"), F.col("b"), F.length("a"), F.length("b"))
    got = rows.select(way(linededup.near).alias("n"), way(linededup.near_by_bands).alias("m"), (F.levenshtein("a", "b") <= 2).alias("w")).collect()
    assert all(x["n"] == x["m"] == x["w"] for x in got) and {x["n"] for x in got} == {True, False}
