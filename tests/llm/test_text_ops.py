"""Near-duplicates, lines, contamination and tokens against brute force on small tables."""

import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidemark.llm import bpe, decontam, linededup, simhash, similar
from tidemark.llm.components import connected_components

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute_fingerprint(text):
    w = re.findall("[^\x20\x09-\x0d]+", lower(text))
    if not w:
        return 0
    sh = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    root = dict.fromkeys(fps)
    for i in fps:
        root[i] = i

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 3:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in fps}


def test_simhash_query(spark, documents):
    r = random.Random(2)
    base = [prose(r, 400) for _ in range(6)]
    near = [t.replace("alpha", "omega", 1) for t in base for _ in range(2)]
    texts = base + near + [base[0]] * 5 + [None, "", " \t", "One", "one", "Ärger É", prose(r, 20_000)]
    got = {x["doc_id"]: (x["fingerprint"], x["component_id"]) for x in simhash.op1_simhash(spark, documents(texts)).collect()}
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    roots = brute_components(fps)
    assert got == {i: (f"{fps[i]:016x}", roots[i]) for i in fps}
    assert len(set(roots.values())) < len(texts)


def test_simhash_links_of_dense_groups(monkeypatch):
    """A group of near fingerprints in one cell is connected as brute force connects it, also where cells are split."""
    r = random.Random(5)
    base = r.getrandbits(64)
    points = {base}
    for _ in range(300):
        points.add(base ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 6))))
    points |= {r.getrandbits(64) for _ in range(50)}
    array = np.array(sorted(points), np.uint64)
    root = {int(p): int(p) for p in array}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in simhash.forest(array):
        root[find(b)] = find(a)
    want = brute_components({int(p): int(p) for p in array})
    groups = lambda f: {frozenset(p for p in root if f(p) == c) for c in {f(p) for p in root}}
    assert groups(find) == groups(want.__getitem__)


def test_simhash_bands_meet():
    """Any two fingerprints within three bits share a cell, and the grid's distance never exceeds the exact one."""
    r, masks = random.Random(1), simhash.band_masks()
    for _ in range(500):
        a = r.getrandbits(64)
        b = a ^ sum(1 << i for i in r.sample(range(64), 3))
        u, v = (int(simhash.unary(np.array([x], np.uint64))[0]) for x in (a, b))
        assert (u ^ v).bit_count() <= 3
        assert any(u & m == v & m for m in masks)


@pytest.mark.parametrize("most", [30, 3])
def test_simhash_large_cells(spark, monkeypatch, most):
    """Cells that are cut into parts (30), and those that are then split into blocks (3)."""
    monkeypatch.setattr(simhash, "MAX_CELL", most)
    monkeypatch.setattr(simhash, "SMALL_RUN", 2)
    r = random.Random(3)
    base = r.getrandbits(63)
    points = sorted({base ^ sum(1 << b for b in r.sample(range(63), 2)) for _ in range(150)} | {base} | {r.getrandbits(63) for _ in range(20)})
    df = spark.createDataFrame([(p,) for p in points], "fp long")
    roots = {x["node"]: x["root"] for x in connected_components(simhash.links(df)).collect()}
    want = brute_components({p: p for p in points})
    groups = lambda of: {frozenset(p for p in points if of(p) == c) for c in {of(p) for p in points}}
    assert groups(lambda p: roots.get(p, p)) == groups(want.__getitem__)


def test_simhash_search_hands_large_cells_back_in_parts(monkeypatch):
    monkeypatch.setattr(simhash, "MAX_CELL", 50)
    cell, fp = np.repeat(np.arange(6), [3, 40, 500, 1, 51, 7]), np.arange(602) * 1001
    batches = [pa.RecordBatch.from_arrays([pa.array(cell[i : i + 37]), pa.array(fp[i : i + 37])], ["cell", "fp"]) for i in range(0, 602, 37)]
    out = list(simhash._search(iter(batches)))
    assert max(b.num_rows for b in out if b.num_rows and b.column(3)[0].as_py()) <= 50 + 37
    handed = [x for b in out for x in b.to_pylist() if x["large"]]
    assert sorted((x["cell"], x["a"]) for x in handed) == [(int(c), int(f)) for c, f in zip(cell, fp, strict=True) if c in (2, 4)]


def test_components_of_paths(spark):
    r = random.Random(9)
    names = [r.getrandbits(60) for _ in range(120)]
    edges = [(names[i], names[i + 1]) for i in range(99)] + [(names[100], names[101]), (names[101], names[100]), (names[110], names[110])]
    got = {x["node"]: x["root"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[n] for n in names[:100]}) == 1 and got[names[100]] == got[names[101]] != got[names[0]]
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_stage_keeps_one_of_each_group(spark, documents):
    r = random.Random(4)
    a, b = prose(r, 300), prose(r, 300)
    docs = spark.read.parquet(documents([a, b, a, a.upper(), "", None, b], ids=[5, 6, 7, 8, 9, 10, None]) + "/documents.parquet")
    kept = simhash.stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((x["doc_id"] for x in kept.collect()), key=str) == [5, 6, 9, None]
    twice = docs.where("doc_id = 5").union(docs.where("doc_id = 5"))
    assert simhash.stage(spark, twice, "").count() == 1
    other = docs.where("doc_id = 6").selectExpr("5L AS doc_id", "text", "lang", "source", "n_chars").union(docs.where("doc_id = 5"))
    assert simhash.stage(spark, other, "").count() == 2  # unrelated texts under one id
    odd = docs.selectExpr("doc_id", "text", "1 AS h", "2 AS `set`", "3 AS `a.b`", "4 AS _doc", "5 AS stays")
    assert simhash.stage(spark, odd, "").columns == odd.columns and simhash.stage(spark, odd, "").count() == 4
    assert simhash.stage(spark, docs.where("doc_id = 99"), "").count() == 0


def test_simhash_stage_against_brute_force(spark, documents):
    """Groups by exact five-word Jaccard of 0.8, also where fingerprints differ in many bits."""
    r = random.Random(14)
    base, texts = [" ".join(f"w{r.randrange(3000)}" for _ in range(r.randint(20, 200))) for _ in range(12)], []
    passage = prose(r, 30)
    for t in base:
        for _ in range(8):
            w = t.split()
            for at in r.sample(range(len(w)), r.randint(0, max(1, len(w) // 20))):
                w[at] = "changed" + str(r.randrange(9))
            texts.append(" ".join(w) + (" " + passage if r.random() < 0.2 else ""))
    texts += [texts[3], texts[3].upper(), "one two", "one two", None, ""]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (lower(t).split() for t in texts)]
    root = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and root[i] != root[j]:
            low, high = sorted((root[i], root[j]))
            root = [low if x == high else x for x in root]
    docs = spark.read.parquet(documents(texts) + "/documents.parquet")
    assert {x["doc_id"] for x in simhash.stage(spark, docs, "").collect()} == set(root)
    fps = [brute_fingerprint(t) for t in texts]
    assert any(root[i] == root[j] and (fps[i] ^ fps[j]).bit_count() > 3 for i, j in itertools.combinations(range(len(texts)), 2))


def test_sketches_differ_in_no_more_bits_than_sets_in_shingles():
    r = np.random.default_rng(1)
    for n in (0, 1, 40, 500):
        for share in (0.5, 0.95, 1):
            a = np.unique(r.integers(0, 2**63, size=n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
            b = np.unique(np.concatenate((a[r.random(len(a)) < share], r.integers(0, 2**63, size=n // 20).astype(np.uint64))))
            bits = np.bitwise_count(similar.sketch(a).view(np.uint64) ^ similar.sketch(b).view(np.uint64)).sum()
            assert bits <= len(np.setxor1d(a, b)) and (share < 1 or n // 20 or bits == 0)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_lines(texts):
    seen, out = [], []
    for t in texts:
        kept = []
        for line in (t or "").split("\n"):
            if re.search(r"[^\W_]", line):
                dup = any(line == s or (len(line) >= 30 <= len(s) and abs(len(line) - len(s)) <= 2 and distance(line, s) <= 2) for s in seen)
                seen.append(line)
                if dup:
                    continue
            kept.append(line)
        out.append(None if t is None else "\n".join(kept))
    return out


def edited(r, line):
    line = list(line)
    for _ in range(r.randint(0, 4)):
        at, what = r.randrange(len(line)), r.randrange(3)
        if what == 0:
            line[at] = r.choice("xyzé")
        elif what == 1:
            line.insert(at, r.choice("xyz"))
        else:
            del line[at]
    return "".join(line)


def test_lines_against_brute_force(spark, documents):
    r = random.Random(8)
    pool = [prose(r, 7) for _ in range(12)] + ["short line", "é" * 31, "Straße und Überfluss, naïve Zeilen hier drüben", "--- ***", ""]
    texts = ["\n".join(edited(r, x) if len(x) >= 30 and r.random() < 0.7 else x for x in r.choices(pool, k=r.randint(1, 6))) for _ in range(60)]
    texts += [None, "", "\n\n", texts[0], "y" * 50_000]
    path = documents(texts)
    docs = spark.read.parquet(path + "/documents.parquet").select("doc_id", "text")
    got = {x["doc_id"]: x["text"] for x in linededup.dedup_lines(docs).collect()}
    want = brute_lines(texts)
    assert got == dict(enumerate(want))


def test_lines_against_sql(spark, documents):
    """DuckDB counts edits in bytes, so its lines are plain here."""
    r = random.Random(18)
    pool = [prose(r, 7) for _ in range(8)] + ["short line", "--- ***", ""]
    texts = ["\n".join(edited(r, x).replace("é", "q") if len(x) >= 30 and r.random() < 0.7 else x for x in r.choices(pool, k=4)) for _ in range(40)]
    path = documents(texts)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet/*.parquet')")
    assert sorted(con.execute(linededup.ORACLE_SQL).fetchall()) == sorted(tuple(x) for x in linededup.op8_line_dedup(spark, path).collect())


def test_lines_of_a_document_given_twice(spark, documents):
    docs = spark.read.parquet(documents(["a b c\na b c", "a b c\na b c", "a b c"], ids=[1, 1, 2]) + "/documents.parquet")
    assert sorted((x["doc_id"], x["text"]) for x in linededup.stage(spark, docs, "").collect()) == [(1, "a b c"), (1, "a b c"), (2, "")]
    assert linededup.stage(spark, docs, "").columns == docs.columns
    assert linededup.stage(spark, docs.where("doc_id > 5"), "").count() == 0


def brute_hits(text, items):
    words = lambda t: [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(t)) if w]
    w, hit, found = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        n = min(13, len(iw))
        for s in range(len(iw) - n + 1 if iw else 0):
            for at in range(len(w) - n + 1):
                if w[at : at + n] == iw[s : s + n]:
                    hit |= set(range(at, at + n))
                    found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)


def test_contamination_against_brute_force(spark, documents):
    r = random.Random(6)
    items = [(i, prose(r, r.choice([5, 13, 20, 40]))) for i in range(12)] + [(12, "Zebra"), (13, "..."), (14, None), (3, prose(r, 15)), (15, "ÉTÉ été Straße")]
    texts = []
    for _ in range(60):
        parts = [prose(r, r.randint(0, 60))]
        for _ in range(r.randint(0, 2)):
            i = r.choice(items)[1] or ""
            cut = i.split()
            parts += [", ".join(cut[r.randint(0, 3) :]).upper() if r.random() < 0.4 else i, prose(r, r.randint(0, 30))]
        texts.append(" ".join(parts))
    texts += [None, "", "zebra", "a zebra.", "été ÉTÉ ÉTÉ été straße", prose(r, 3000) + " " + items[4][1], texts[0]]
    path = documents(texts, benchmark=(items, "item_id long, text string"))
    got = {x["doc_id"]: tuple(x)[1:] for x in decontam.op9_decontaminate(spark, path).collect()}
    assert got == {i: brute_hits(t, [(a, b or "") for a, b in items]) for i, t in enumerate(texts)}


def test_contamination_without_benchmark(spark, documents):
    path = documents(["a b c", None], benchmark=([], "item_id long, text string"))
    assert [x["n_hit"] for x in decontam.op9_decontaminate(spark, path).collect()] == [0, 0]
    docs = spark.read.parquet(path + "/documents.parquet")
    assert decontam.stage(spark, docs, path).columns == docs.columns


def test_stages_keep_columns_of_any_name(spark, documents):
    """Columns named like figures, with dots, or like inner names; and ids that are null or empty."""
    r = random.Random(3)
    item, line = prose(r, 20), prose(r, 8)
    path = documents([], benchmark=([(1, item)], "item_id long, text string"))
    rows = [(None, line + "\nnull id"), ("", line + "\nempty id"), ("a", item), ("b", line), ("b", line), ("c", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").selectExpr("doc_id", "text", "7 AS n_lines", "8 AS n_removed", "9 AS n_words", "10 AS n_hit", "11 AS items", "12 AS `a.b`", "13 AS _doc", "14 AS _h", "15 AS _i", "16 AS lid")
    lines = linededup.stage(spark, docs, path)
    assert lines.columns == docs.columns
    assert sorted((str(x["doc_id"]), x["text"]) for x in lines.collect()) == [("", "empty id"), ("None", line + "\nnull id"), ("a", item), ("b", ""), ("b", ""), ("c", None)]
    assert {tuple(x)[2:] for x in lines.collect()} == {tuple(range(7, 17))}
    clean = decontam.stage(spark, docs, path)
    assert clean.columns == docs.columns and sorted(str(x["doc_id"]) for x in clean.collect()) == ["", "None", "b", "b", "c"]
    assert linededup.dedup_lines(docs).columns[-2:] == ["n_lines", "n_removed"] and decontam.contamination(docs, spark.read.parquet(path + "/benchmark.parquet")).where("n_hit > 0").count() == 1


def test_lines_of_a_family_of_near_copies(spark, documents):
    """Variants of one line, most of them too far from each other to be linked, in documents of random order."""
    r = random.Random(21)
    words = [r.choice(WORDS) for _ in range(12)]
    family = [" ".join(w if r.random() > 0.08 else r.choice([w[:-1], w + "s", r.choice(WORDS)]) for w in words) for _ in range(160)]
    texts = ["\n".join(r.sample(family, 2)) for _ in range(120)]
    docs = spark.read.parquet(documents(texts) + "/documents.parquet").select("doc_id", "text")
    assert {x["doc_id"]: x["text"] for x in linededup.dedup_lines(docs).collect()} == dict(enumerate(brute_lines(texts)))


SPELT = ["", "a<|endoftext|>b  c<|endoftext|>", "aaaaaaa aaaa", "\u0085 \x1c\x1d x", "don't  we'll　x 'S 'sa", "日本語 ½²٣", "😀👍🏽 é", "\x00\x00", " " * 50 + "x", "1234567890" * 40]


def test_bpe_equals_the_library():
    from tokenizers import Tokenizer

    path = bpe.default_path()
    mine, library = bpe.PairIndexBpe(path), Tokenizer.from_file(path)
    r = random.Random(7)
    texts = SPELT + ["".join(r.choice(" '  \n\tstrelvmdSa1é½!-　日😀") for _ in range(r.randint(0, 40))) for _ in range(400)] + [prose(r, 500)]
    flat, ends = mine.encode_batch(texts)
    start, back = 0, mine.decode_batch(flat, ends)
    for text, end, raw, want in zip(texts, ends.tolist(), back, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert flat[start:end].tolist() == want.ids
        assert raw.decode("utf-8", "replace") == library.decode(want.ids, skip_special_tokens=False) == text
        start = end
    assert mine.decode(mine.encode("naïve")) == "naïve"


def test_bpe_query(spark, documents, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_CHARS", 20)
    got = {x["doc_id"]: x for x in bpe.op4_bpe(spark, documents([*SPELT, None])).collect()}
    mine = bpe.PairIndexBpe(bpe.default_path())
    for i, t in enumerate([*SPELT, ""]):
        ids = mine.encode(t)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


@pytest.mark.parametrize("a,b", [("kitten" * 6, "kitten" * 6), ("x" * 40, "x" * 38), ("abcdefghij" * 4, "abcdefghij" * 3 + "bcdefghijk"), ("q" + "ab" * 20, "ab" * 20 + "q")])
def test_edit_distance_within(spark, a, b):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(list(a), list(b))], "a array<string>, b array<string>").select(linededup.within(F.col("a"), F.col("b")).alias("w")).first()
    assert row["w"] == (distance(a, b) <= 2)
