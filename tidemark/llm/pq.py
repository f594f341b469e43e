"""Vector code compression: product quantization with exact integer assignments found by float32 matrix products.

Components become integers, vectors are cut into equal parts, and each part position has a codebook that rounds of assigning and
averaging refine. Every assignment is the exact nearest entry (ties: the lower index), though most of the work is one float32 matrix product for
a block of rows: |x|^2 is the same for all entries, so 2 x.c - |c|^2 decides, and the product's rounding error is at most
``gamma * |x| * |c|`` whatever the order of summation. Entries whose interval reaches the best one's are evaluated again in 64-bit integers.

Each round is one pass over the table: a task sums its rows by entry, so it hands on at most a row for each entry however many rows it read, and Spark
adds these up. The driver holds the codebooks, whose size is a parameter, and nothing that grows with the rows.

Defined cases: rows whose vector is null, or holds a null or a component that is not finite as a float, are dropped, as are rows whose length is
no positive multiple of ``parts`` or differs from that of the first kept row by id; codebooks start from the ``entries`` smallest ids (null ids
last, equal ids by their vectors), or from all rows where there are fewer; unused entries stay; repeated rows each count; null labels belong
together; no row left or an empty table gives no rows. Components of any finite float are exact: rows or entries beyond ``WIDE`` go through
Python integers, and an error that a long can't hold is null. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialize, read

BLOCK = 4096  # rows of one matrix product
WIDE = 1 << 26  # integers below are summed and squared in 64 bits without overflow, up to vectors of 512 components a part
LIMB = 60  # bits of the pieces in which sums travel
SALTS = 32  # pieces of a label, so that no task joins all rows of a common one


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite; NaN is above every number in Spark."""
    inside = lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, inside)


def integers(vectors: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) of equally long vectors as 64-bit integers, or as Python integers if one needs them."""
    flat = np.asarray(vectors.flatten()).astype(np.float64) * scale
    rows = flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 0)
    low = np.floor(rows)
    if not low.size or np.abs(low).max() < 2.0**62:
        return low.astype(np.int64)
    out = np.empty(low.shape, object)
    out[:] = [[int(x) for x in r] for r in low.tolist()]
    return out


class Codebook:
    """The entries of one part position, as integers of any size."""

    def __init__(self, entries: list[list[int]]):
        self.entries = entries
        self.small = np.array([max(map(abs, e), default=0) < WIDE for e in entries], bool)
        self.exact = np.array([e if s else [0] * len(e) for e, s in zip(entries, self.small, strict=True)], np.int64).reshape(len(entries), -1)
        self.single = self.exact.astype(np.float32)
        self.square = (self.exact * self.exact).sum(axis=1).astype(np.float64)
        d = self.exact.shape[1]
        # Unit roundoff of float32: d products and sums, and both operands' own rounding, with room for the float64 steps after it.
        unit = (d + 3) * 2.0**-24
        self.slack = 2.02 * unit / (1 - unit) * np.sqrt(self.square)
        self.widest = min((max(map(abs, e)) for e, s in zip(entries, self.small, strict=True) if not s), default=None)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each row, in exact integers (an object array where rows are wide)."""
        if x.dtype == object or (x.size and np.abs(x).max() >= WIDE):
            wide = np.array([max(map(abs, r), default=0) >= WIDE for r in x.tolist()], bool)
            index, error = np.zeros(len(x), np.int64), np.zeros(len(x), object)
            index[~wide], error[~wide] = self.nearest(x[~wide].astype(np.int64))
            for k in np.flatnonzero(wide):
                error[k], index[k] = self._plain(x[k].tolist())
            return index, error
        if not self.small.any():
            found = [self._plain(r) for r in x.tolist()]
            return np.array([i for _, i in found], np.int64), np.array([e for e, _ in found], object)
        score = 2.0 * (x.astype(np.float32) @ self.single.T).astype(np.float64) - self.square  # larger is nearer
        norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        slack = norm[:, None] * self.slack + (np.abs(score) + self.square) * 2.0**-50
        low = np.where(self.small, score - slack, -np.inf)
        row, entry = np.nonzero((score + slack >= low.max(axis=1)[:, None]) & self.small)
        away = x[row] - self.exact[entry]
        distance = (away * away).sum(axis=1)
        first = np.searchsorted(row, np.arange(len(x)))
        least = np.minimum.reduceat(distance, first) if len(x) else distance
        # Candidates of a row stand in ascending order of entries, so the first that is least wins the tie.
        hit = np.flatnonzero(distance == least[row])
        index = entry[hit[np.searchsorted(row[hit], np.arange(len(x)))]]
        if self.widest is not None:
            # A wide entry is at least this far from a row of small components.
            gap = float(self.widest) - np.abs(x).max(axis=1)
            for k in np.flatnonzero(gap * gap * 0.999 <= least.astype(np.float64)):
                e, index[k] = self._plain(x[k].tolist())
                least = least.astype(object)
                least[k] = e
        return index, least

    def _plain(self, x: list[int]) -> tuple[int, int]:
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(self.entries))

    def sums(self, x: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Sum of the rows of each entry: 64-bit integers, or Python integers where rows are wide."""
        if x.dtype == object or (x.size and np.abs(x).max() >= WIDE):
            out = np.zeros((len(self.entries), x.shape[1]), object)
            for r, i in zip(x.astype(object), index.tolist(), strict=True):
                out[i] = out[i] + r
            return out
        # Below 2^53: exact in floats.
        return np.stack([np.bincount(index, c, len(self.entries)) for c in x.T.astype(np.float64)], axis=1).astype(np.int64)


def _blocks(batches, width: int, scale: int):
    """Batches in blocks with their integer vectors, which stand in the last column."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            x = integers(part.column(part.num_columns - 1), scale)
            yield part, x.reshape(part.num_rows, width)


def split(total: int) -> tuple[int, int, int]:
    """Three limbs of a sum, so that sums of limbs stay within decimals."""
    mask = (1 << LIMB) - 1
    return total >> 2 * LIMB, total >> LIMB & mask, total & mask


def first_books(kept: DataFrame, parts: int, entries: int, scale: int) -> tuple[int, list[list[list[int]]]]:
    """The length of vectors and each part's first codebook: the vectors of the smallest ids, of which there are ``entries`` at most."""
    head = kept.orderBy(F.asc_nulls_last("id"), "vector").limit(1).collect()
    if not head:
        return 0, []
    width = len(head[0]["vector"])
    rows = kept.where(F.size("vector") == width).orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").collect()
    x = integers(pa.array([r[0] for r in rows], pa.list_(pa.float32())), scale).reshape(len(rows), width).tolist()
    d = width // parts
    return width, [[r[p * d : (p + 1) * d] for r in x] for p in range(parts)]


def refine(kept: DataFrame, books: list[list[list[int]]], scale: int) -> list[list[list[int]]]:
    """One round: assign every part, then put the floor of its parts' mean in place of each entry that has any."""
    parts, entries, d = len(books), len(books[0]), len(books[0][0])

    def run(batches):
        codes = [Codebook(b) for b in books]
        total = [np.zeros((entries, d), object) for _ in codes]
        count = np.zeros((parts, entries), np.int64)
        for _, x in _blocks(batches, parts * d, scale):
            for p, code in enumerate(codes):
                piece = x[:, p * d : (p + 1) * d]
                index, _ = code.nearest(piece)
                count[p] += np.bincount(index, minlength=entries)
                total[p] = total[p] + code.sums(piece, index)
        used = [(p, e) for p in range(parts) for e in range(entries) if count[p, e]]
        if not used:
            return
        limbs = [[split(int(v)) for v in total[p][e]] for p, e in used]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in used], pa.int32()), pa.array([e for _, e in used], pa.int32()), pa.array([int(count[u]) for u in used], pa.int64()), pa.array([[{"a": a, "b": b, "c": c} for a, b, c in r] for r in limbs], _SUMS)],
            ["part", "entry", "n", "sums"],
        )

    partial = kept.select("vector").mapInArrow(run, "part int, entry int, n long, sums array<struct<a: long, b: long, c: long>>")
    whole = [F.sum(F.col(f"s.{k}").cast("decimal(20,0)")).alias(k) for k in "abc"]
    added = partial.select("part", "entry", "n", F.posexplode("sums").alias("i", "s")).groupBy("part", "entry", "i").agg(F.sum("n").alias("n"), *whole)
    out = [[list(e) for e in b] for b in books]
    for r in added.collect():  # a row for each component of the codebooks at most
        out[r["part"]][r["entry"]][r["i"]] = ((int(r["a"]) << 2 * LIMB) + (int(r["b"]) << LIMB) + int(r["c"])) // r["n"]
    return out


_SUMS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64())]))


def assign(kept: DataFrame, books: list[list[list[int]]], scale: int) -> DataFrame:
    """The columns before the vector, then ``codes`` (binary, a byte for each part) and ``error``."""
    parts, d = len(books), len(books[0][0])
    before = kept.drop("vector")
    names = [*before.columns, "codes", "error"]

    def run(batches):
        codes = [Codebook(b) for b in books]
        for part, x in _blocks(batches, parts * d, scale):
            found = [c.nearest(x[:, p * d : (p + 1) * d]) for p, c in enumerate(codes)]
            index = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            error = sum(e.astype(object) if any(f[1].dtype == object for f in found) else e for _, e in found)
            errors = pa.array([int(e) if e < 2**63 else None for e in error], pa.int64()) if error.dtype == object else pa.array(error, pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([r.tobytes() for r in index], pa.binary()), errors], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in before.schema)
    return kept.select(*before.columns, "vector").mapInArrow(run, f"{fields}, codes binary, error long")


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, list[list[list[int]]]]:
    """A table of id, label, codes and error of every kept row (to be discarded by the caller), and the final codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte for each part: 1 to 256 entries")
    kept = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<float>").alias("vector")).where(finite(F.col("vector")) & (F.size("vector") > 0) & (F.size("vector") % parts == 0))
    width, books = first_books(kept, parts, entries, scale)
    if not books:
        return materialize(kept.select("id", "label", F.lit(b"").alias("codes"), F.lit(0).cast("long").alias("error")).where("false"), "codes"), []
    kept = kept.where(F.size("vector") == width)
    for _ in range(rounds):
        books = refine(kept, books, scale)
    return materialize(assign(kept, books, scale), "codes"), books


def label_errors(coded: DataFrame) -> DataFrame:
    """The rows with ``label_error``, the sum of error over equal labels (null if a long can't hold it).

    Rows of a common label are dealt out over ``SALTS`` pieces, each of which meets a copy of the label's one sum.
    """
    none, salt = F.col("label").isNull(), F.col("_salt")
    key = F.coalesce(F.col("label").cast("string"), F.lit(""))
    known = F.when(F.count_if(F.col("error").isNull()) == 0, F.sum(F.col("error").cast("decimal(20,0)")))
    sums = coded.groupBy(key.alias("_key"), none.alias("_none")).agg(known.try_cast("long").alias("label_error")).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = coded.select("*", key.alias("_key"), none.alias("_none"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("_salt"))
    return rows.join(sums, ["_key", "_none", "_salt"]).drop("_key", "_none", "_salt")


def books_digest(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()


def reconstruct(coded: DataFrame, books: list[list[list[int]]], scale: int = 1024) -> DataFrame:
    """The rows with ``vector``, the centres of the integer cells that the codes stand for."""
    table = F.array(*[F.array(*[F.array(*[F.lit((v + 0.5) / scale) for v in e]) for e in b]) for b in books])
    at = lambda p: F.element_at(F.element_at(table, p + 1), F.conv(F.hex(F.substring("codes", p + 1, 1)), 16, 10).cast("int") + 1)
    return coded.withColumn("vector", F.concat(*[at(p) for p in range(len(books))]))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(read(spark, sf_dir, "embeddings"))
    out = label_errors(coded)
    return out.select(F.col("id").alias("vec_id"), F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def _oracle(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    nearest = "(list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c))::BIGINT * 256 + e"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"a{k} AS MATERIALIZED (SELECT r, p, min({nearest}) AS m FROM pieces JOIN b{k} USING (p) GROUP BY r, p)")
        if k < rounds:
            steps.append(f"s{k} AS MATERIALIZED (SELECT p, e, list(v ORDER BY i) AS c FROM (SELECT p, m % 256 AS e, i, floor(sum(v) / count(*)) AS v FROM (SELECT p, m, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{k} JOIN pieces USING (r, p)) GROUP BY ALL) GROUP BY p, e)")
            steps.append(f"b{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(s.c, b.c) AS c FROM b{k} b LEFT JOIN s{k} s USING (p, e))")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS MATERIALIZED (SELECT r, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) t(p)),
b0 AS MATERIALIZED (SELECT p, r AS e, x AS c FROM pieces WHERE r < {entries}),
{", ".join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', m % 256), '' ORDER BY p) AS code, sum(m // 256)::BIGINT AS error FROM a{rounds} GROUP BY r),
books AS (SELECT sha256(string_agg(t, ',' ORDER BY p, e)) AS h FROM (SELECT p, e, array_to_string(list_transform(c, lambda x: x::BIGINT), ',') AS t FROM b{rounds}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM kept JOIN coded USING (r), books
"""


ORACLE_SQL = _oracle()
