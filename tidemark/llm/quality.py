"""Quality classifier: a byte-level convolutional network in numpy.

A document's UTF-8 bytes are embedded, learned filters run over overlapping chunks of CHUNK bytes every
STRIDE bytes across the whole document, each filter is max-pooled over all chunks, and a logistic unit
combines the maxima into one probability.

Training is on the driver, on a bounded sample of labelled rows: the ``max_rows`` rows of least hash of
their id, as far as their texts come to ``max_bytes`` (documented bounds; every labelled row is used while there are
fewer). Scoring covers every byte of every document.

Defined cases: a null or empty text is one chunk of zero bytes and gets the probability learned for that;
repeated rows get equal scores, as scores are rounded to five places, beyond which a batch's order of sums shows;
without any labelled row of both classes every score is the share of label 1 (0.5 without labels); an empty table gives no
rows; a null doc_id counts as not held out and is never trained on; ``score`` replaces a column of that name, while the
pipeline's stage returns all columns as they came, whatever their names.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

CHUNK, STRIDE, EMBED, FILTERS = 16, 8, 8, 16
MAX_TRAIN_ROWS = 2500
MAX_TRAIN_BYTES = 256 << 20
EPOCHS = 14
LEAST_STEPS = 600  # of training; a small set is gone through more often
THRESHOLD = 0.3
HOLD_OUT = 5


@dataclass
class ByteCnn:
    embed: np.ndarray  # (256, EMBED)
    kernel: np.ndarray  # (CHUNK * EMBED, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    out: np.ndarray  # (FILTERS,)
    out_bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.pooled(texts)[0] @ self.out + self.out_bias, -30, 30)))

    def pooled(self, texts: list[bytes], where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Maximum of each filter over each document's chunks, and the chunk that reached it."""
        raw, blocks = lay_out(texts)
        step = STRIDE * EMBED
        x = self.embed[raw].reshape(-1, step)
        taps = CHUNK // STRIDE
        y = x @ np.concatenate([self.kernel[t * step : (t + 1) * step] for t in range(taps)], axis=1)
        n = len(x) - taps + 1
        z = y[:n, :FILTERS].copy()
        for t in range(1, taps):
            z += y[t : t + n, t * FILTERS : (t + 1) * FILTERS]
        z += self.bias
        np.maximum(z, 0, out=z)
        # Chunk i begins at block i; the last taps-1 blocks of a document begin none of its own.
        ends = np.cumsum(blocks)
        bounds = np.stack((ends - blocks, ends - taps + 1), axis=1).ravel()
        if bounds[-1] == n:
            bounds = bounds[:-1]
        top = np.maximum.reduceat(z, bounds, axis=0)[::2]
        if not where:
            return top, None
        at = np.stack([b + z[b : e - taps + 1].argmax(axis=0) for b, e in zip((ends - blocks).tolist(), ends.tolist(), strict=True)])
        return top, at


def lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in a row, each padded with zero bytes to whole blocks of STRIDE and one chunk at least."""
    padded = [t + bytes(max(CHUNK, -(-len(t) // STRIDE) * STRIDE) - len(t)) for t in texts]
    return np.frombuffer(b"".join(padded), np.uint8), np.array([len(p) // STRIDE for p in padded], np.int64)


def train(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> ByteCnn:
    """Adam on the log loss, classes weighted to even halves of the gradient."""
    rng = np.random.default_rng(seed)
    w = {
        "embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        "kernel": rng.normal(0, 1 / np.sqrt(CHUNK * EMBED), (CHUNK * EMBED, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "out": rng.normal(0, 0.3, FILTERS).astype(np.float32),
        "out_bias": np.zeros(1, np.float32),
    }
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        flat = min(max(share, 1e-3), 1 - 1e-3)
        return ByteCnn(w["embed"], w["kernel"], w["bias"], np.zeros(FILTERS, np.float32), float(np.log(flat / (1 - flat))))
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    step = 0
    epochs = max(epochs, min(200, LEAST_STEPS // max(1, len(texts) // 32)))
    for epoch in range(epochs):
        rate = 0.01 * (0.5 + 0.5 * np.cos(np.pi * epoch / epochs))
        for part in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // 32)):
            own, step = [texts[i] for i in part], step + 1
            net = ByteCnn(w["embed"], w["kernel"], w["bias"], w["out"], float(w["out_bias"][0]))
            top, at = net.pooled(own, where=True)
            p = 1 / (1 + np.exp(-np.clip(top @ w["out"] + w["out_bias"], -30, 30)))
            err = ((p - labels[part]) * weight[part] / len(part)).astype(np.float32)
            g = {"out": top.T @ err + 1e-3 * w["out"], "out_bias": err.sum(keepdims=True)}
            pre = np.outer(err, w["out"]) * (top > 0)  # gradient at the winning chunks
            raw, _ = lay_out(own)
            chunk = raw[(at * STRIDE)[:, :, None] + np.arange(CHUNK)]  # (docs, filters, CHUNK)
            seen = w["embed"][chunk].reshape(len(part), FILTERS, -1)
            g["kernel"] = np.einsum("df,dfi->if", pre, seen)
            g["bias"] = pre.sum(axis=0)
            back = np.einsum("df,if->dfi", pre, w["kernel"]).reshape(-1, EMBED)
            g["embed"] = np.zeros_like(w["embed"])
            np.add.at(g["embed"], chunk.ravel(), back)
            for k in w:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                w[k] = (w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    # Undo the even weighting, so that scores follow the share of label 1.
    return ByteCnn(w["embed"], w["kernel"], w["bias"], w["out"], float(w["out_bias"][0] + np.log(share / (1 - share))))


def held_out(key: str = "doc_id", folds: int = HOLD_OUT):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", max_rows: int = MAX_TRAIN_ROWS, max_bytes: int = MAX_TRAIN_BYTES) -> ByteCnn:
    """Train on the labelled rows outside the held-out fold, at most ``max_rows`` of them, chosen by a hash of the id."""
    known = labels.select(F.col(key).alias("_k"), F.col(label).alias("_y")).where(F.col("_y").isin(0, 1) & F.col("_k").isNotNull())
    order = F.xxhash64(F.col("_k").cast("string"))
    picked = known.where(~held_out("_k")).groupBy("_k").agg(F.max("_y").alias("_y")).orderBy(order, "_k").limit(max_rows)
    rows = F.broadcast(picked)  # max_rows rows at most
    mine = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).join(rows, "_k").groupBy("_k").agg(F.max(F.coalesce("_t", F.lit(""))).alias("_t"), F.max("_y").alias("_y"))
    got, size = [], 0
    for r in mine.orderBy(order, "_k").toLocalIterator():
        got.append((r["_k"], r["_t"].encode(), r["_y"]))
        size += len(got[-1][1])
        if size > max_bytes:
            break
    got.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), str(r[0])))
    return train([r[1] for r in got], np.array([r[2] for r in got], np.float32))


BATCH_BYTES = 300_000


def _scored(docs: DataFrame, net: ByteCnn, text: str) -> DataFrame:
    """``_doc`` (the row) and ``_score``; one row for each row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    place = docs.columns.index(text)

    def run(batches):
        net = model.value
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(0).field(place).to_pylist()]
            out, start = np.zeros(len(texts)), 0
            while start < len(texts):
                stop, size = start, 0
                while stop < len(texts) and (stop == start or size + len(texts[stop]) <= BATCH_BYTES):
                    size += len(texts[stop])
                    stop += 1
                out[start:stop] = net.scores(texts[start:stop])
                start = stop
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.round(out.astype(np.float64), 5))], ["_doc", "_score"])

    return rows.mapInArrow(run, rows.select("_doc", F.lit(0.0).alias("_score")).schema)


def score(docs: DataFrame, net: ByteCnn, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs``, and ``score`` (in place of a column of that name); one row for each row."""
    return _scored(docs, net, text).select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns if c.lower() != "score"], F.col("_score").alias("score"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, with the columns they came with."""
    kept = _scored(docs, fit(docs, read(spark, sf_dir, "labels")), "text").where(F.col("_score") >= THRESHOLD)
    return kept.select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
