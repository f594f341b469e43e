"""Near-duplicate groups: SimHash links first, completed by an exact join at a five-word Jaccard similarity of 0.8 or more.

Every document gets the SimHash fingerprint and the set of its five-word shingles. Fingerprints within three bits of each
other, found by the segment-popcount grid of ``simhash``, are candidates. A prefix-filtered join finds what lies farther
apart: shingles have one order for all documents (frequent ones last, then by hash), two similar sets share a shingle among
the first n - ceil(0.8 n) + 1 of each, so every similar pair meets in the cell of such a shingle; pairs whose sizes or
places rule the similarity out are dropped, and so are those whose sketches differ in more bits than similar sets can differ in
shingles. All candidates are verified by the exact similarity of their texts.

Equal sets are one. Each cell first links its members to its smallest, next to the SimHash links; then only pairs that these
links have not connected yet are compared, so a large group of near copies makes about as many pairs as it has members. Most shingles stand in
one set only; the first round hands on the places of the others, and only these are shuffled again.

A text of fewer than five words is one shingle; texts without words are equal. Shingles are compared by 64-bit hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, discard, materialize
from .components import connected_components
from .simhash import links, majority

WIDTH = 5
#: What counts as frequent, and how many such shingles are known to all tasks. Both only order shingles; any order is right.
FREQUENT, MAX_FREQUENT = 32, 100_000
MAX_PAIRS, MAX_ROWS = 1 << 18, 1 << 18  # that a task holds before it hands them on; a cell is never divided
CHUNK_BYTES = 1 << 20  # of texts whose shingles are cut together
PAIRS_PER_BATCH = 200  # whose texts are verified together, which bounds a worker's memory
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_SETS = 2_000_000  # 16 MB of hashes; more of them are joined by shuffle

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and their inverses."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _POWERS[:] = [np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)))) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, by in ((32, 0xD6E8FEB86659FD93), (29, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(32))


def all_shingles(texts: list[str | None]) -> list[np.ndarray]:
    """For each text the hashes of its shingles, repeats included."""
    out: list[np.ndarray] = []
    raw, size = [], 0
    for i, t in enumerate(texts):
        raw.append((t or "").encode().translate(LOWER))
        size += len(raw[-1])
        if size > CHUNK_BYTES or i == len(texts) - 1:
            out += _shingles(raw)
            raw, size = [], 0
    return out


def _shingles(raw: list[bytes]) -> list[np.ndarray]:
    line = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    blank = _IS_SPACE[line]
    starts, ends = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1, np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    power, inverse = _powers(len(line) + 1)
    # A word's hash is a difference of sums over bytes and places, moved to place 0.
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((line.astype(np.uint64) + np.uint64(1)) * power[: len(line)])))
    words = _mixed((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    if len(words) >= WIDTH:
        rows = len(words) - WIDTH + 1
        wide = _mixed(sum((words[k : k + rows] * power[k + 1] for k in range(1, WIDTH)), words[:rows] * power[0]))
    first = np.searchsorted(starts, np.cumsum([1] + [len(r) + 1 for r in raw]))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= WIDTH:
            out.append(wide[a : b - WIDTH + 1])
        else:
            short = words[a:b]
            out.append(_mixed(np.sum(short * power[1 : b - a + 1], keepdims=True) + np.uint64(b - a)) if b > a else short)
    return out


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the distinct shingles, in order."""
    return np.unique(all_shingles([text])[0])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * both >= 4 * (len(a) + len(b) - both)


SKETCH = 4  # words of 64 bits


def sketch(s: np.ndarray) -> np.ndarray:
    """For each of 256 hash values whether an odd number of shingles has it; two sets differ in as many shingles at least as in bits."""
    odd = np.bincount((s & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def in_slices(batches, rows: int = 512):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def prefixes(docs: DataFrame, text: str) -> DataFrame:
    """``h``, ``n``: how often each shingle stands in a prefix by hash alone; summed within parts of a task."""

    def run(batches):
        for batch in in_slices(batches, 2048):
            sets = [np.unique(s) for s in all_shingles(batch.column(0).to_pylist())]
            h, n = np.unique(np.concatenate([s[: len(s) - -(-4 * len(s) // 5) + 1] for s in sets]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    return docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def sketches(docs: DataFrame, key: str, text: str, frequent: np.ndarray) -> DataFrame:
    """``key``, ``h`` (the text's identity), ``set`` (hash of the set), ``n`` (its size), ``fp``, ``bits``, ``prefix``, ``text``; one row for each row."""
    base = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    known = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        for batch in in_slices(batches):
            texts = batch.column(1).to_pylist()
            own, ids, sizes, fps, bits, prefixes = [], [], [], [], [], []
            for t, every in zip(texts, all_shingles(texts), strict=True):
                s = np.unique(every)
                own.append(xxhash.xxh3_64_intdigest((t or "").encode()))
                ids.append(xxhash.xxh64_intdigest(s.tobytes(), 1))
                sizes.append(len(s))
                fps.append(majority(every))
                bits.append(sketch(s))
                late = np.isin(s, known.value, assume_unique=True)
                ordered = np.concatenate((s[~late], s[late]))
                prefixes.append(ordered[: len(s) - -(-4 * len(s) // 5) + 1].view(np.int64))
            longs = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (own, ids, fps)]
            yield pa.RecordBatch.from_arrays([batch.column(0), longs[0], longs[1], pa.array(sizes, pa.int32()), longs[2], pa.array(bits, pa.list_(pa.int64())), pa.array(prefixes, pa.list_(pa.int64())), batch.column(1)], ["key", "h", "set", "n", "fp", "bits", "prefix", "text"])

    return base.mapInArrow(run, f"key {base.schema['key'].dataType.simpleString()}, h long, set long, n int, fp long, bits array<long>, prefix array<long>, text string")


def meetings(first: bool):
    """Pairs of each run of equal cells: with its first member only, or all whose labels differ.

    The former also hands on the members of each run of two or more, as rows of ``a`` (the set) and ``at`` (its place in the prefix).
    In the latter case two members with the same shingle just before this one have met in its cell, where every bound is looser, so
    they are left out here: a pair is made once for each run of shared shingles, not once for each shared shingle.
    """

    def batch_of(a, b, at=None):
        columns = [pa.array(a), pa.array(b)]
        if first:
            columns.append(pa.nulls(len(a), pa.int32()) if at is None else pa.array(at.astype(np.int32)))
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "at"][: len(columns)])

    def run(batches):
        parts, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                parts.append([batch.column(i).to_numpy() for i in range(batch.num_columns)])
                rows += batch.num_rows
            if rows > MAX_ROWS:
                columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
                last = int(np.searchsorted(columns[0], columns[0][-1]))
                if last:
                    yield from within([x[:last] for x in columns])
                parts, rows = [[x[last:].copy() for x in columns]], 0
        if parts:
            yield from within([np.concatenate(x) for x in zip(*parts, strict=True)])

    def within(columns):
        cell, own, n, at, *more = columns
        label, before, *bits = (None, None) if first else more
        start = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        held, size = [], 0

        def flush():
            pairs = np.unique(np.concatenate(held), axis=0)
            return batch_of(pairs[:, 0], pairs[:, 1])

        i, lag = np.arange(len(cell)), 1
        size_of = np.diff(np.append(start, len(cell)))
        head = np.repeat(start, size_of)
        if first:
            shared = np.repeat(size_of > 1, size_of)
            yield batch_of(own[shared], own[shared], at[shared])
        while len(i):
            if first:
                i = np.flatnonzero(head != i)
                j = head[i]
            else:
                i = i[i + lag < len(cell)]
                i = i[cell[i] == cell[i + lag]]
                j = i + lag
            low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            rest = 1 + np.minimum(n[i] - at[i] - 1, n[j] - at[j] - 1)
            ok = (5 * low >= 4 * high) & (9 * rest >= 4 * (low + high))
            if not first:
                ok &= (label[i] != label[j]) & ((before[i] != before[j]) | (at[i] == 0) | (at[j] == 0))
            if bits:
                i_, j_ = i[ok], j[ok]
                differ = sum(np.bitwise_count((b[i_] ^ b[j_]).view(np.uint64)).astype(np.int64) for b in bits)  # of signed numbers it counts the absolute value's
                ok[ok] = 9 * differ <= n[i_] + n[j_]
            held.append(np.column_stack([np.minimum(own[i], own[j])[ok], np.maximum(own[i], own[j])[ok]]))
            size += int(ok.sum())
            if size > MAX_PAIRS:
                yield flush()
                held, size = [], 0
            if first:
                break
            lag += 1
        if size:
            yield flush()

    return run


def verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs of similar sets."""
    ids = pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct()
    ids = materialize(ids, "ids")
    few = F.broadcast(ids) if ids.count() <= MAX_BROADCAST_SETS else ids
    texts = materialize(rows.select("set", "text").join(few, "set", "left_semi").groupBy("set").agg(F.first("text").alias("text")), "texts")
    both = pairs.join(texts.select(F.col("set").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("set").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches):
        for batch in in_slices(batches, PAIRS_PER_BATCH):
            sets = [[np.unique(s) for s in all_shingles(batch.column(i).to_pylist())] for i in (2, 3)]
            ok = [similar(x, y) for x, y in zip(*sets, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    out = materialize(both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long"), "links", PAIRS_PER_BATCH)
    discard(texts, ids)
    return out


def by_fingerprint(sets: DataFrame) -> DataFrame:
    """Pairs of sets whose fingerprints are equal or linked, as many as connect them."""
    points = materialize(sets.groupBy("fp").agg(F.min("set").alias("first")), "points")
    equal = sets.join(points, "fp").where("set <> first").select(F.least("set", "first").alias("a"), F.greatest("set", "first").alias("b"))
    of = lambda side: points.select(F.col("fp").alias(side), F.col("first").alias("f" + side))
    near = links(points.select("fp")).join(of("a"), "a").join(of("b"), "b")
    return equal.union(near.select(F.least("fa", "fb").alias("a"), F.greatest("fa", "fb").alias("b")))


def similar_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``h`` (the text's identity), ``first`` (smallest key and h that similar pairs lead to; nulls last); one row for each row."""
    frequent = prefixes(docs, text).where(F.col("n") > FREQUENT).orderBy(F.desc("n"), "h").limit(MAX_FREQUENT).select("h").toArrow().column(0).to_numpy()
    rows = materialize(sketches(docs, key, text, np.sort(frequent.astype(np.int64).view(np.uint64))), "sketches")
    # Nulls go behind all ids, so they name a group only where it has no other.
    place = F.struct(F.col("key").isNull().alias("none"), "key", "h")
    sets = materialize(rows.groupBy("set").agg(F.min(place).alias("least"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bits").alias("bits"), F.first("prefix").alias("prefix")), "sets")

    def meet(first: bool, cells: DataFrame, out: str) -> DataFrame:
        return cells.repartition("cell").sortWithinPartitions("cell", "set").mapInArrow(meetings(first), out)

    cells = sets.select("set", "n", F.posexplode("prefix").alias("at", "cell")).select("cell", "set", "n", "at")
    met = materialize(meet(True, cells, "a long, b long, at int"), "met")
    near = materialize(met.where("at is null").select("a", "b").union(by_fingerprint(sets)).distinct(), "pairs")
    found = verified(near, rows)
    roots = connected_components(found)
    labelled = sets.join(roots, sets["set"] == roots["node"], "left").select("set", "n", "bits", "prefix", F.coalesce("root", "set").alias("label"))
    shared = met.where("at is not null").groupBy(F.col("a").alias("set")).agg(F.collect_list("at").alias("places"))
    places = labelled.join(shared, "set").select("set", "n", "label", "bits", "prefix", F.explode("places").alias("at"))
    before = F.coalesce(F.get("prefix", F.col("at") - 1), F.lit(0).cast("long")).alias("before")
    cells = places.select(F.get("prefix", F.col("at")).alias("cell"), "set", "n", "at", "label", before, *[F.get("bits", F.lit(k)).alias(f"b{k}") for k in range(SKETCH)])
    more = materialize(meet(False, cells, "a long, b long").distinct().join(near, ["a", "b"], "left_anti"), "pairs")
    roots = connected_components(found.unionByName(verified(more, rows)))
    named = materialize(sets.join(roots, sets["set"] == roots["node"], "left").select("set", F.coalesce("root", "set").alias("root"), "least"), "named")
    smallest = named.groupBy("root").agg(F.min("least").alias("first"))
    classes = materialize(named.join(smallest, "root").select("set", F.struct("first.key", "first.h").alias("first")), "classes")
    out = materialize(rows.select("key", "h", "set").join(classes, "set").select("key", "h", "first"), "components")
    discard(rows, sets, met, near, found, more, named, classes)
    return out


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each group of similar texts the one of smallest id, and every row without an id.

    Rows are told apart by id and text, so unrelated texts that share an id both stay; of rows equal in both one stays.
    """
    found = similar_components(docs, key, text)
    ident = found.groupBy("key", "h").agg(F.count("*").alias("n"), F.bool_or(F.struct("key", "h") == F.col("first")).alias("stays")).where("key is not null and (n > 1 or not stays)")
    ident = materialize(ident.select(F.col("key").alias("_k"), F.col("h").alias("_h"), "stays"), "copies")
    discard(found)
    few = ident.count() <= MAX_BROADCAST_ROWS

    def identity(batches):
        for batch in in_slices(batches):
            h = np.array([xxhash.xxh3_64_intdigest((t or "").encode()) for t in batch.column(batch.schema.get_field_index("_t")).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(h.view(np.int64))], [*batch.schema.names[:-1], "_h"])

    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(f"`{key}`").alias("_k"), F.col(f"`{text}`").alias("_t"))
    marked = whole.mapInArrow(identity, whole.select("_doc", "_k", F.lit(0).cast("long").alias("_h")).schema)
    joined = marked.join(F.broadcast(ident) if few else ident, ["_k", "_h"], "left")
    kept = joined.where("stays is null").select("_doc")
    if not ident.where("stays").isEmpty():  # rows equal in id and text
        kept = kept.union(joined.where("stays").dropDuplicates(["_k", "_h"]).select("_doc"))
    return kept.select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
