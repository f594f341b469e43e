"""What the near-dedup stage shuffles: places of shared shingles only in its second round, and no text that is not asked for."""

import random

from pyspark.sql import functions as F

from tidemark.llm import similar


def texts_with_copies(rng):
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(300)]
    return texts + [texts[7] + " end", texts[7] + " more", "begin " + texts[100], texts[100]]


def test_second_round_has_shared_shingles_only(spark, documents, monkeypatch):
    texts = texts_with_copies(random.Random(1))
    docs = spark.read.parquet(documents(texts) + "/documents.parquet")
    seen = spark.sparkContext.accumulator(0)
    meetings = similar.meetings

    def counted(first):
        run = meetings(first)

        def passed(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return run if first else lambda batches: run(passed(batches))

    monkeypatch.setattr(similar, "meetings", counted)
    left = {x["doc_id"] for x in similar.without_copies(docs).collect()}
    assert left == set(range(300))
    # Five texts in two families, each with 12 or 13 shingles in its prefix.
    assert 0 < seen.value <= 5 * 13 + 10


def test_texts_are_fetched_without_a_shuffle_of_all(spark, documents, monkeypatch):
    docs = spark.read.parquet(documents(texts_with_copies(random.Random(2))) + "/documents.parquet")
    plans, materialize = [], similar.materialize

    def seen(df, name="step", *a):
        if name == "texts":
            plans.append(df._jdf.queryExecution().toString())
        return materialize(df, name, *a)

    monkeypatch.setattr(similar, "materialize", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    results = []
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for most in (similar.MAX_BROADCAST_SETS, -1):
            monkeypatch.setattr(similar, "MAX_BROADCAST_SETS", most)
            results.append({x["doc_id"] for x in similar.without_copies(docs).select(F.col("doc_id")).collect()})
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert results == [set(range(300))] * 2
    assert len(plans) == 4 and ["BroadcastHashJoin" in p for p in plans] == [True, True, False, False]
