"""SimHash near-duplicates: a grid range-join over segment popcounts.

A fingerprint of 64 bits is cut into 32 segments of two bits, and each segment's popcount is one
coordinate, so a fingerprint becomes a point of a 32-dimensional grid. The Manhattan distance of two points
never exceeds the Hamming distance of the fingerprints. The coordinates are dealt into six bands: points at a
Manhattan distance of 3 or less agree in at least three bands, so every linked pair meets in one of the
twenty cells that a fingerprint has (one for each choice of three bands). Inside a cell, pairs over the
Manhattan bound are dropped and the rest is verified exactly.

Equal fingerprints are one point. Within a cell only a spanning forest of its links is kept, found by
search from linked points to those not reached yet, so a large group of near copies makes as many links as it
has members. A cell beyond MAX_CELL points is handed back while it is read and cut once more: its points differ in the other
bands only, which are dealt into four parts, one of which linked points must agree in. What is still too large is split into
blocks whose pairs are searched in separate tasks.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; a null doc_id takes part
but never names a component unless no id is in it (then null); repeated rows get equal results; an empty
table gives no rows; only the key and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, discard, materialize, read
from .components import connected_components

SHINGLE = 3
SEED = 42
DISTANCE = 3
BANDS = 6
MAX_CELL = 10_000
SMALL_RUN = 8


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if len(words) <= width:
        return h(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - width]]
    return majority(np.array([h(line[a : b - 1], SEED) for a, b in zip(starts, ends[width - 1 :], strict=True)], np.uint64))


def majority(hashes: np.ndarray) -> int:
    """Each bit as in over half of the hashes; zero without any."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        counts += np.unpackbits(np.ascontiguousarray(hashes[i : i + 4096]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """``key``, ``fp`` (the 64 bits as a signed long); one row for each row of ``docs``."""
    base = docs.select(key, text)

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], [key, "fp"])

    return base.mapInArrow(run, f"`{key}` {base.schema[key].dataType.simpleString()}, fp long")


def _segments(numbers: list[int]) -> int:
    return sum(3 << 2 * s for s in numbers)


def _bands() -> list[list[int]]:
    """Runs of whole two-bit segments."""
    cut = [round(i * 32 / BANDS) for i in range(BANDS + 1)]
    return [list(range(cut[i], cut[i + 1])) for i in range(BANDS)]


def band_masks() -> list[int]:
    """One mask for each choice of half of the bands."""
    return [sum(_segments(_bands()[i]) for i in c) for c in itertools.combinations(range(BANDS), BANDS - DISTANCE)]


def part_masks() -> list[list[int]]:
    """For each choice the masks of DISTANCE + 1 parts of the other bands."""
    out = []
    for c in itertools.combinations(range(BANDS), BANDS - DISTANCE):
        rest = [s for i in range(BANDS) if i not in c for s in _bands()[i]]
        cut = [round(i * len(rest) / (DISTANCE + 1)) for i in range(DISTANCE + 2)]
        out.append([_segments(rest[a:b]) for a, b in itertools.pairwise(cut)])
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


ODD = _signed(0x5555555555555555)


def grid_point(fp: Column) -> Column:
    """Popcounts of the two-bit segments in unary (0: 00, 1: 01, 2: 11), so that XOR and popcount give Manhattan distances."""
    shifted = F.shiftrightunsigned(fp, 1)
    return fp.bitwiseOR(shifted).bitwiseAND(F.lit(ODD)).bitwiseOR(F.shiftleft(fp.bitwiseAND(shifted).bitwiseAND(F.lit(ODD)), 1))


def unary(fp: np.ndarray) -> np.ndarray:
    odd, one = np.uint64(0x5555555555555555), np.uint64(1)
    return ((fp | fp >> one) & odd) | (((fp & (fp >> one)) & odd) << one)


def near(a: np.ndarray, b: np.ndarray, d: int = DISTANCE) -> np.ndarray:
    """Whether fingerprints link: the Manhattan bound first, the exact distance where it holds."""
    ok = np.bitwise_count(unary(a) ^ unary(b)) <= d
    at = np.flatnonzero(ok)
    a, b = np.broadcast_arrays(a, b)
    ok[at] = np.bitwise_count(a[at] ^ b[at]) <= d
    return ok


def forest(points: np.ndarray, d: int = DISTANCE) -> list[tuple[int, int]]:
    """Links that connect whatever is connected within these points."""
    out: list[tuple[int, int]] = []
    left = points
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            p = queue.pop()
            ok = near(left, p, d)
            if ok.any():
                new = left[ok]
                out += [(int(p), int(x)) for x in new]
                queue += list(new)
                left = left[~ok]
    return out


_NAMES = ["a", "b", "cell", "large"]


def _large(cell: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(fp), pa.array(fp), pa.array(cell), pa.array(np.ones(len(fp), bool))], _NAMES)


def _runs(c: np.ndarray, f: np.ndarray):
    """Links within each run of equal cells; runs that are too large are handed back."""
    start = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
    size = np.diff(np.append(start, len(c)))
    small = np.repeat(size <= SMALL_RUN, size)
    none = np.zeros(0, np.int64)
    u, a, b = f.view(np.uint64), [none], [none]
    for lag in range(1, SMALL_RUN):
        if len(c) <= lag:
            break
        i = np.flatnonzero((c[lag:] == c[:-lag]) & small[lag:])
        i = i[near(u[i], u[i + lag])]
        a.append(f[i])
        b.append(f[i + lag])
    for s, n in zip(start[size > SMALL_RUN].tolist(), size[size > SMALL_RUN].tolist(), strict=True):
        if n > MAX_CELL:
            yield _large(c[s : s + n], f[s : s + n])
        elif links := forest(u[s : s + n]):
            x = np.array(links, np.uint64).view(np.int64)
            a.append(x[:, 0])
            b.append(x[:, 1])
    x, y = np.concatenate(a), np.concatenate(b)
    yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(np.zeros(len(x), np.int64)), pa.array(np.zeros(len(x), bool))], _NAMES)


def _search(batches):
    """Links within the cells of a partition sorted by cell. At most MAX_CELL points and a batch are held."""
    cells, points, held, given = [], [], 0, None  # ``given``: a cell that is being handed back
    for batch in batches:
        c, f = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if given is not None and len(c):
            n = int(np.searchsorted(c, given, side="right"))
            if n:
                yield _large(c[:n], f[:n])
            c, f = c[n:], f[n:]
        if not len(c):
            continue
        last = int(np.searchsorted(c, c[-1]))
        if held and (last or cells[0][0] != c[0]):
            yield from _runs(np.concatenate([*cells, c[:last]]), np.concatenate([*points, f[:last]]))
            cells, points, held = [], [], 0
        elif last:
            yield from _runs(c[:last], f[:last])
        cells.append(c[last:])
        points.append(f[last:])
        held += len(c) - last
        given = None
        if held > MAX_CELL:
            yield _large(np.concatenate(cells), np.concatenate(points))
            cells, points, held, given = [], [], 0, c[-1]
    if held:
        yield from _runs(np.concatenate(cells), np.concatenate(points))


_LINKS = "a long, b long, cell long, large boolean"


def links(points: DataFrame) -> DataFrame:
    """``a``, ``b``: links that connect all fingerprints of ``points`` (distinct ``fp``) within DISTANCE of each other."""
    masks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(_signed(m)).alias("m")) for i, m in enumerate(band_masks())])
    # A cell's number ends in that of its choice of bands.
    numbered = lambda i, *of: F.xxhash64(i, *of).bitwiseAND(F.lit(~31)).bitwiseOR(i)
    cells = points.select("fp", F.explode(masks).alias("k"), grid_point(F.col("fp")).alias("g")).select(numbered(F.col("k.i"), F.col("g").bitwiseAND(F.col("k.m"))).alias("cell"), "fp")
    search = lambda df: materialize(df.repartition("cell").sortWithinPartitions("cell").mapInArrow(_search, _LINKS), "links")
    found = search(cells)
    out, large = found.where("not large").select("a", "b"), found.where("large").select("cell", F.col("a").alias("fp"))
    if not large.isEmpty():
        parts = F.array(*[F.array(*[F.struct(F.lit(j).alias("j"), F.lit(_signed(m)).alias("m")) for j, m in enumerate(own)]) for own in part_masks()])
        cut = large.select("cell", "fp", grid_point(F.col("fp")).alias("g"), F.explode(F.get(parts, F.col("cell").bitwiseAND(F.lit(31)).cast("int"))).alias("k"))
        found = search(cut.select(F.xxhash64("cell", "k.j", F.col("g").bitwiseAND(F.col("k.m"))).alias("cell"), "fp"))
        out, large = out.union(found.where("not large").select("a", "b")), found.where("large").select("cell", F.col("a").alias("fp"))
    if not large.isEmpty():
        # Blocks of at most about a third of MAX_CELL points; each pair of blocks is searched on its own.
        blocks = large.groupBy("cell").agg(F.ceil(F.count("*") / (MAX_CELL / 3)).cast("int").alias("n"))
        dealt = large.join(blocks, "cell").withColumn("r", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("n")).cast("int")).withColumn("s", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        paired = dealt.select(F.xxhash64("cell", F.least("r", "s"), F.greatest("r", "s")).alias("cell"), "fp").distinct()
        out = out.union(search(paired).where("not large").select("a", "b"))
    return out.distinct()


def components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fp``, ``component_id`` (smallest key reachable); one row for each row of ``docs``."""
    fps = materialize(fingerprints(docs, key, text), "fingerprints")
    points = materialize(fps.groupBy("fp").agg(F.min(key).alias("least")), "points")
    roots = connected_components(links(points))
    named = points.join(roots, points["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    linked = materialize(named.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    by_fp = materialize(named.join(linked, "root").select("fp", "component_id"), "classes")
    discard(points, linked)
    return fps.join(by_fp, "fp").select(key, "fp", "component_id")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies, and any without an id; rows equal in id and text count once."""
    from .similar import without_copies  # which builds on this module

    return without_copies(docs)
