"""The pipeline's stages in order: on planted documents, against brute force, and on odd rows."""

import hashlib
import itertools
import random

import numpy as np
from test_text_ops import brute_hits, brute_lines, lower

from tidemark.llm import quality
from tidemark.llm.common import materialize

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def test_pipeline(spark, documents):
    import corpus_pipeline

    r = random.Random(1)
    prose = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
    clean = [prose(120) for _ in range(40)]
    bad = [prose(80).replace(" ", "### ") for _ in range(20)]
    item = prose(30)
    texts = clean + bad + [clean[0], item]
    labels = [(i, 1, 0) for i in range(40)] + [(i, 0, 0) for i in range(40, 60)]
    path = documents(texts, labels=(labels * 1, "doc_id long, quality int, toxic int"), benchmark=([(1, item)], "item_id long, text string"))
    docs = spark.read.parquet(path + "/documents.parquet")
    columns = docs.columns
    sizes = []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, path), "test")
        sizes.append(docs.count())
        if len(sizes) < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
    kept = {x["doc_id"] for x in docs.select("doc_id").collect()}
    assert set(range(40)) - kept == set()
    assert not kept & set(range(40, 60)) and 61 not in kept
    assert len([n for n, _ in corpus_pipeline.STAGES]) == 5


def test_pipeline_against_brute_force(spark, documents):
    from tokenizers import Tokenizer

    import corpus_pipeline
    from tidemark.llm import bpe

    r = random.Random(11)
    prose = lambda n: " ".join(f"{r.choice(WORDS)}{r.randrange(60)}" for _ in range(n))
    item, shared = prose(26), prose(60)
    texts = []
    for i in range(50):
        base = [prose(r.randint(8, 40)) for _ in range(r.randint(1, 4))]
        if i % 7 == 0:
            base = [x.replace(" ", "### ") for x in base]
        if i % 5 == 1:
            base.insert(0, shared)
        if i % 9 == 2:
            base.append(item)
        texts.append("\n".join(base))
    for i in range(15):  # near copies, and exact ones
        words = texts[i].split(" ")
        for _ in range(i % 3):
            words[r.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [None, "", "\n", "***"]
    labels = [(i, int(i % 7 != 0), 0) for i in range(50)]
    path = documents(texts, labels=(labels, "doc_id long, quality int, toxic int"), benchmark=([(1, item), (2, prose(5))], "item_id long, text string"))
    items = [(x["item_id"], x["text"]) for x in spark.read.parquet(path + "/benchmark.parquet").collect()]
    docs = spark.read.parquet(path + "/documents.parquet")
    net = quality.fit(docs, spark.read.parquet(path + "/labels.parquet"))
    left = {i: t for i, t in enumerate(texts) if round(float(net.scores([(t or "").encode()])[0]), 5) >= quality.THRESHOLD}
    left = dict(zip(left, brute_lines(list(left.values())), strict=True))
    words = {i: lower(t).split() for i, t in left.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    root = {i: i for i in left}
    for i, j in itertools.combinations(sorted(left), 2):
        if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and root[i] != root[j]:
            low, high = sorted((root[i], root[j]))
            root = {k: low if x == high else x for k, x in root.items()}
    left = {i: t for i, t in left.items() if root[i] == i and not brute_hits(t, items)[-1]}
    library = Tokenizer.from_file(bpe.default_path())
    want = {}
    for i, t in left.items():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    got = {x["doc_id"]: tuple(x)[1:] for x in corpus_pipeline.run(spark, path).collect()}
    assert got == want and 20 < len(want) < 50


def test_pipeline_of_odd_rows(spark, documents):
    import corpus_pipeline

    none = "doc_id long, quality int, toxic int"
    r = random.Random(2)
    text = " ".join(r.choice(WORDS) for _ in range(60))
    path = documents([None, "", text, text, "x" * 100_000], ids=[1, 2, 3, 3, None], labels=([], none), benchmark=([], "item_id long, text string"))
    ids = [x["doc_id"] for x in corpus_pipeline.run(spark, path).collect()]
    assert sorted(ids, key=str) == [1, 3, None]  # texts without words are alike; rows equal in id and text count once


def test_pipeline_of_nothing(spark, documents):
    import corpus_pipeline

    path = documents([], labels=([], "doc_id long, quality int, toxic int"), benchmark=([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, path).count() == 0
