"""Target-distribution importance resampling over hashed word n-grams, by a streaming CRC ring.

One scan of a document keeps the running CRC states of the last ``n`` starts in a ring: each word extends every state by a space and
the word, begins a state of its own, and every state then gives the bucket of the run that ends there. No n-gram is ever built as a
string, and a long text is scanned a slice at a time with the ring carried over.

A row holds at most one count for each bucket, however long its text. Buckets are summed over all source and all target texts, which
gives every bucket a gain; a document's weight is the sum of the gains of its features. Gumbel noise drawn from the id makes the
highest scores a sample without replacement in proportion to the weights. Ranks come from a range partitioning and the sizes of its
ranges, so no task orders all documents.

Defined cases: a null or wordless text has no features and weight 0, and is never drawn while ``least_words`` is above 0; a null id
counts as an empty one in the noise and comes last among ties; repeated rows are scored and drawn each by itself; an empty table gives no rows, and
an empty target gives every bucket its gain from a count of 0; only the key and text columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialize, read

#: Bytes of words to themselves, A-Z to a-z, all others to a space.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
SLICE = 1 << 20  # bytes scanned at a time


class CrcRing:
    """The buckets of all runs of 1 to ``n`` words, as the words come in."""

    def __init__(self, n: int, buckets: int):
        self.n, self.buckets, self.states = n, buckets, []

    def extend(self, words: list[bytes]) -> np.ndarray:
        if self.n == 1:  # a ring of one state, begun anew by each word
            return np.fromiter(map(crc32, words), np.uint32, len(words)) % self.buckets
        states, out, last = self.states, [], self.n - 1
        for w in words:
            more = b" " + w
            states = [crc32(more, s) for s in states[-last:]]
            states.append(crc32(w))
            out += states
        self.states = states
        return np.array(out, np.uint32) % self.buckets


def slices(text: bytes, size: int = SLICE):
    """Lists of words; a text is cut at spaces only."""
    start = 0
    while start < len(text):
        stop = text.find(b" ", start + size)
        stop = len(text) if stop < 0 else stop
        yield text[start:stop].split()
        start = stop


def features(text: str | None, n: int, buckets: int, size: int = SLICE) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Words, features, the buckets that occur in ascending order, and how often each does."""
    ring, words, first, counts = CrcRing(n, buckets), 0, np.zeros(0, np.int64), None
    for k, part in enumerate(slices((text or "").encode().translate(_WORDS), size)):
        words += len(part)
        found = ring.extend(part)
        if not k:
            first = found
            continue
        if counts is None:  # a long text: no more than a count for each bucket is held
            counts = np.bincount(first, minlength=buckets)
        counts += np.bincount(found, minlength=buckets)
    if counts is None:
        found, times = np.unique(first, return_counts=True)
    else:
        found = np.flatnonzero(counts)
        times = counts[found]
    return words, int(times.sum()), found.astype(np.int32), times.astype(np.int64)


def noise(seed: int, key) -> int:
    """Gumbel noise in thousandths, from the first 32 bits of a digest of the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scan(docs: DataFrame, n: int, buckets: int, seed: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_words, n_features, noise (null without a seed), buckets, counts; one row for each row of ``docs``."""
    base = docs.select(F.col(f"`{key}`").alias("id") if key else F.lit(None).cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    schema = f"id {base.schema['id'].dataType.simpleString()}, n_words long, n_features long, noise long, buckets array<int>, counts array<long>"

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # long lists of buckets are handed on early
                part = batch.slice(at, 256)
                rows = [features(t.as_py(), n, buckets) for t in part.column(1)]
                drawn = [None if seed is None else noise(seed, k.as_py()) for k in part.column(0)]
                ends = np.cumsum([0, *(len(r[2]) for r in rows)]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([r[i] for r in rows]))) for i in (2, 3)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(drawn, pa.int64()), *lists], ["id", "n_words", "n_features", "noise", "buckets", "counts"])

    return base.mapInArrow(run, schema)


def totals(scanned: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket: one number for each bucket is all that reaches the driver."""
    rows = scanned.select(F.explode(F.arrays_zip("buckets", "counts")).alias("f")).groupBy("f.buckets").agg(F.sum("f.counts")).collect()
    out = np.zeros(buckets, np.int64)
    for b, c in rows:
        out[b] = c
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares of each bucket, target over source."""
    m, s_all, t_all = float(len(source)), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + m) / ((s + 1.0) * (t_all + m)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weighted(scanned: DataFrame, gain: np.ndarray) -> DataFrame:
    """id, n_words, n_features, weight, score."""

    def run(batches):
        for b in batches:
            buckets, counts = b.column(4), b.column(5)
            ends = np.asarray(buckets.offsets)
            flat = gain[np.asarray(buckets.flatten())] * np.asarray(counts.flatten())
            sums = np.concatenate(([0], np.cumsum(flat)))
            ends = ends - ends[0]
            weight = sums[ends[1:]] - sums[ends[:-1]]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(weight, pa.int64()), pa.array(weight + np.asarray(b.column(3)), pa.int64())], ["id", "n_words", "n_features", "weight", "score"])

    return scanned.mapInArrow(run, f"id {scanned.schema['id'].dataType.simpleString()}, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, n: int = 2, buckets: int = 10_000, seed: int = 0, percent: int = 10, least_words: int = 20, key: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """``key``, n_features, weight, score and rank of every row: of those with ``least_words``, ``percent`` in a hundred are drawn.

    ``rank`` numbers the drawn rows from the highest score on (ties: the smaller id first) and is null in all others.
    """
    scanned = materialize(scan(docs, n, buckets, seed, key, text), "features")
    wanted = totals(scan(target, n, buckets, None, "", target_text), buckets)
    scored = materialize(weighted(scanned, gains(totals(scanned, buckets), wanted)), "scored")
    discard(scanned)
    order = [F.col("n_words") < least_words, F.desc("score"), F.asc_nulls_last("id"), F.col("n_features"), F.col("weight")]
    ranged = scored.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()  # the range in the upper bits, the row's place in it in the lower 33
    laid = materialize(ranged.select("*", F.shiftright(place, 33).alias("_range"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")), "ranged")
    discard(scored)
    sizes = sorted((r["_range"], r["n"], r["all"]) for r in laid.groupBy("_range").agg(F.count_if(F.col("n_words") >= least_words).alias("n"), F.count("*").alias("all")).collect())
    before, starts = 0, []
    for r, k, _ in sizes:
        starts.append((r, before))
        before += k
    drawn = before * percent // 100
    starts_frame = docs.sparkSession.createDataFrame(starts, "_range long, _before long")
    rank = F.col("_before") + F.col("_place") + 1
    eligible = F.col("n_words") >= least_words
    # One row for each range of the partitioning, so this side is small at any size of the input.
    return laid.join(F.broadcast(starts_frame), "_range").select(F.col("id").alias(key), "n_features", "weight", "score", F.when(eligible & (rank <= drawn), rank).alias("rank"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), n=1, buckets=10_000, seed=2024, percent=10, least_words=20)


ORACLE_SQL = r"""
WITH RECURSIVE texts AS (SELECT doc_id, 0 AS target, text FROM documents UNION ALL SELECT NULL, 1, text FROM benchmark),
docs AS (SELECT row_number() OVER () AS r, doc_id, target, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
occ AS (SELECT r, target, unnest(words) AS w FROM docs),
per AS (SELECT r, target, w, count(*) AS c FROM occ GROUP BY ALL),
step(b, k, v) AS (SELECT range, 0, range FROM range(256) UNION ALL SELECT b, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM step WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY b) AS t FROM step WHERE k = 8),
bytes AS (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM per)),
run(w, h, i, s) AS (SELECT w, h, 0, 4294967295 FROM bytes UNION ALL
  SELECT w, h, i + 1, xor(s // 256, t[xor(s % 256, (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1) + 1]) FROM run, crc_table WHERE 2 * i < length(h)),
bucket AS (SELECT w, xor(s, 4294967295) % 10000 AS b FROM run WHERE 2 * i = length(h)),
counts AS (SELECT b, coalesce(sum(c) FILTER (target = 0), 0) AS s, coalesce(sum(c) FILTER (target = 1), 0) AS t FROM per JOIN bucket USING (w) GROUP BY b),
totals AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM counts),
gain AS (SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS g FROM counts, totals),
weights AS (SELECT r, sum(c * g)::BIGINT AS weight FROM per JOIN bucket USING (w) JOIN gain USING (b) GROUP BY r),
drawn AS (SELECT doc_id, len(words) AS n, coalesce(weight, 0) AS weight, sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8] AS h FROM docs LEFT JOIN weights USING (r) WHERE target = 0),
noisy AS (SELECT *, list_sum(list_transform(range(1, 9), lambda i: (strpos('0123456789abcdef', h[i]) - 1) * 16 ** (8 - i)))::DOUBLE AS u FROM drawn),
scored AS (SELECT doc_id, n, weight, weight + floor(-1000 * ln(-ln((u + 0.5) / 4294967296)))::BIGINT AS score FROM noisy),
ranked AS (SELECT *, CASE WHEN n >= 20 THEN row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id) END AS k, count(*) FILTER (n >= 20) OVER () AS eligible FROM scored)
SELECT doc_id, n::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score, (CASE WHEN k <= 10 * eligible // 100 THEN k END)::BIGINT AS rank FROM ranked
"""
