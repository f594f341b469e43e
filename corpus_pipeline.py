"""Corpus pipeline: quality, line dedup, near-duplicates, contamination, then tokens; each stage reads what the last one wrote.

Defined cases: an empty table gives no rows; a null text counts as empty in every stage and keeps its row as long as no stage rejects
it; texts without words are near copies of each other; rows equal in id and text count once from the near-duplicate stage on; a
document without an id is never dropped as a copy; other columns pass through up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontam, linededup, quality, simhash
from tidemark.llm.common import discard, materialize, read

STAGES = [
    ("quality classifier", quality.stage),
    ("line dedup", linededup.stage),
    ("simhash near-dedup", simhash.stage),
    ("benchmark decontamination", decontam.stage),
    ("bpe tokens", bpe.stage),
]

#: The classifier and the tokenizer have no SQL form; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return done
        done = materialize(done, "stage")
        if i:
            discard(docs)
        docs = done
    return docs
