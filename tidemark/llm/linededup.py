"""Line dedup: a segment-partition edit join on lines, in DataFrame functions only.

Two lines are linked if they are equal, or if both have MIN_CHARS code points or more and their edit distance is
at most THRESHOLD. A line is removed if an equal or linked line occurs earlier in the corpus, in the order of
document id and line number; the first of its kind stays. Lines without a letter or digit are layout and stay.

A line of MIN_CHARS or more is cut into THRESHOLD + 1 segments of nearly equal length. Of two lines within
THRESHOLD edits, the shorter has a segment that stands unchanged in the longer, near its own place: the index
holds each line's segments by its length, and each line probes it, for every length from its own down to THRESHOLD
less, with the substrings at the places that remain possible (shifts bounded by the edits left on either side).
Candidate pairs are verified by Spark's edit distance, long lines by a banded bit-parallel one: one machine word holds, for each number of
edits, the diagonals within the band that are reachable, and one step handles all of them for a character.

Equal lines are one line before the join, counted with their first place, so a line that millions of documents
share is joined once. A line needs one earlier linked line only, so families of near copies take two rounds. In the
first, every line that shares a key meets that key's leader, its earliest indexed line: as many pairs as there are
lines. In the second, lines that are still not removed meet the other lines of their keys: in families of up to MAX_FAMILY
indexed lines those that agree in one part of their letter counts, cut into so many parts that two linked lines agree in one; in larger
ones by a second partition into pieces of PIECE characters. Of two linked lines, any THRESHOLD + 1 pieces of one include a piece that
stands unchanged in the other, so each line is met by its pieces that are rarest in the family only. Nothing is capped.

Equality of lines is by two hashes of 64 bits with different seeds; everything after that goes by the line's number.

Defined cases: a null text has no lines and stays null; an empty text is one empty line and stays; rows equal in id
and text count as one document and get equal results; documents without an id come first, and are told from those with an
empty id; an empty table gives an empty one; documents are never dropped, one that loses all its lines keeps an empty
text; other columns, whatever their names, pass through, but for those named like the two figures that are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialize, read

THRESHOLD = 2
MIN_CHARS = 30
BAND = 2 * THRESHOLD + 1
#: Letters whose counts (modulo 16) tell most pairs apart: an edit changes two of the counts by one at most.
LETTERS = "etaonihrsldcumgp"
MAX_COUNTS_APART = 2 * THRESHOLD
#: So many groups of letters that MAX_COUNTS_APART differences leave one without any.
GROUPS = MAX_COUNTS_APART + 1
#: An edit takes away two pairs of neighbouring characters and makes two at most, each of which flips one bit of a sketch.
MAX_FLIPS = 4 * THRESHOLD
PREFIXES = 16
#: Longer lines are compared by bands; both ways give the same distance.
MAX_PLAIN = 2_000
#: Families of more indexed lines than this are cut by rarest pieces; both ways find the same links.
MAX_FAMILY = 256
PIECE = 5
MAX_BROADCAST_LINES = 500_000  # 8 MB of line numbers; more of them are joined by shuffle


def line_rows(docs: DataFrame) -> DataFrame:
    """``pos`` (place in the corpus), ``h1``, ``h2`` (the line's identity), ``line``: every line with a letter or digit."""
    place = F.struct(F.col("_id").alias("id"), F.col("_h").alias("h"), F.col("n").alias("n"))
    lines = docs.select("_id", "_h", F.posexplode_outer(F.split("_text", "\n")).alias("n", "line")).where(F.col("line").rlike(r"[\p{L}\p{N}]"))
    return lines.select(place.alias("pos"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), "line")


def distinct_lines(docs: DataFrame) -> DataFrame:
    """``lid`` (a number), ``pos`` (first place), ``line``, ``len``: every worded line once."""
    grouped = line_rows(docs).groupBy("h1", "h2").agg(F.min("pos").alias("pos"), F.first("line").alias("line"))
    return materialize(grouped.select(F.monotonically_increasing_id().alias("lid"), "pos", "line", F.length("line").alias("len")), "lines")


def segment(length: Column, i: Column) -> tuple[Column, Column]:
    """Start (from 0) and length of the i-th of THRESHOLD + 1 segments; the last ones take the remainder."""
    k = THRESHOLD + 1
    base = F.call_function("div", length, F.lit(k)).cast("int")
    plain = k - length % k  # so many segments without a character of the remainder
    return i * base + F.greatest(i - plain, F.lit(0)), base + (i >= plain).cast("int")


def probes() -> list[tuple[int, int, int]]:
    """How much shorter the indexed line is, the number of its segment, and how far to the right of its own place the segment may stand."""
    out = []
    for shorter in range(THRESHOLD + 1):
        for i in range(THRESHOLD + 1):
            # i edits may lie to the left of segment i (from 0), THRESHOLD - i to its right, and the lengths differ by `shorter`.
            low, high = max(-i, shorter - (THRESHOLD - i)), min(i, shorter + (THRESHOLD - i))
            out += [(shorter, i, shift) for shift in range(low, high + 1)]
    return out


def segment_keys(lines: DataFrame, places: list[tuple[int, int, int]], *kept: Column) -> DataFrame:
    """``kept`` and ``key``, once for each place (as in ``probes``): a hash of the indexed line's length, the segment's number and its text.

    The places are rows, so what is compiled is one key. Where all characters of a line are single bytes its segments are cut out as bytes, without
    counting characters; the hash of a string is that of its bytes, so both ways give the same keys.
    """
    each = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(("shorter", "i", "shift"), p, strict=True)]) for p in places])
    rows = lines.select("lid", "pos", "line", F.col("line").cast("binary").alias("bytes"), "len", (F.octet_length("line") == F.col("len")).alias("single"))
    rows = rows.select("*", F.explode(each).alias("p")).withColumn("length", F.col("len") - F.col("p.shorter")).where(F.col("length") >= MIN_CHARS)
    start, size = segment(F.col("length"), F.col("p.i"))
    rows = rows.select("*", (start + F.col("p.shift") + 1).alias("start"), size.alias("size"))
    key = lambda text: F.xxhash64("length", "p.i", F.substring(text, F.col("start"), F.col("size")))
    return rows.select(*kept, F.when(F.col("single"), key(F.col("bytes"))).otherwise(key(F.col("line"))).alias("key"))


def index_rows(lines: DataFrame) -> DataFrame:
    """``key`` of each segment."""
    return segment_keys(lines, [(0, i, 0) for i in range(THRESHOLD + 1)], F.col("lid"), F.col("pos.id").alias("id"))


def probe_rows(lines: DataFrame) -> DataFrame:
    """``key`` of each substring that may be a segment of a line as long as this one or up to THRESHOLD shorter.

    ``who`` is the line's number, or its complement where the substring is the line's own segment.
    """
    own = (F.col("p.shorter") == 0) & (F.col("p.shift") == 0)
    return segment_keys(lines, probes(), F.when(own, F.bitwise_not("lid")).otherwise(F.col("lid")).alias("who"))


def letter_counts(line: Column) -> Column:
    out = F.lit(0).cast("long")
    for i, c in enumerate(LETTERS):
        n = (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c)))).bitwiseAND(F.lit(15)).cast("long")
        out = out.bitwiseOR(F.shiftleft(n, 4 * i))
    return out


def counts_apart(a: Column, b: Column) -> Column:
    """Sum of the differences of two lines' letter counts; over MAX_COUNTS_APART the lines can't be within THRESHOLD edits."""
    out = F.lit(0)
    for i in range(len(LETTERS)):
        x, y = (F.shiftrightunsigned(c, 4 * i).bitwiseAND(F.lit(15)).cast("int") for c in (a, b))
        d = (x - y).bitwiseAND(F.lit(15))
        out = out + F.least(d, 16 - d)
    return out


def pair_sketch(line: Column) -> Column:
    """64 bits, each the parity of the number of neighbouring pairs of characters that hash to it."""
    # Bound by a lambda, so that the characters are split once.
    pairs = F.transform(F.array(F.split(line, "")), lambda c: F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), lambda x, y: F.call_function("shiftleft", F.lit(1).cast("long"), F.xxhash64(x, y).bitwiseAND(F.lit(63)).cast("int"))))
    return F.aggregate(F.get(pairs, F.lit(0)), F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(x))


def may_link(a: str, b: str) -> Column:
    """Whether the lines may be within THRESHOLD edits, by length, letter counts and sketch."""
    col = lambda side, name: F.col(f"{side}.{name}")
    return (
        (F.abs(col(a, "len") - col(b, "len")) <= THRESHOLD)
        & (F.bit_count(col(a, "sketch").bitwiseXOR(col(b, "sketch"))) <= MAX_FLIPS)
        & (counts_apart(col(a, "sig"), col(b, "sig")) <= MAX_COUNTS_APART)
    )


def within(a: Column, b: Column, whole: bool = True) -> Column:
    """Whether the edit distance of two arrays of characters, whose sizes differ by THRESHOLD at most, is at most THRESHOLD.

    With ``whole`` false: whether it can be, when a and b are only the beginnings of what is compared.

    The state is one word of THRESHOLD + 1 levels of BAND bits. Bit d of level e: diagonal d - THRESHOLD (place in a
    less place in b) can be reached with e edits. One step takes a character of b and moves all diagonals of all
    levels at once: along matches; to the next level by substitution, or by insertion one diagonal down; then by deletions,
    one diagonal up at the next level.
    """
    levels = THRESHOLD + 1
    every = (1 << BAND * levels) - 1
    copies = sum(1 << BAND * e for e in range(levels))
    no_low, no_high = every & ~copies, every & ~(copies << (BAND - 1))

    def deletions(x: Column) -> Column:
        return x.bitwiseOR(F.shiftleft(x.bitwiseAND(F.lit(no_high)), BAND + 1).bitwiseAND(F.lit(every)))

    def step(x: Column, match: Column) -> Column:
        along = x.bitwiseAND(match)
        edits = F.shiftleft(x, BAND).bitwiseOR(F.shiftleft(x.bitwiseAND(F.lit(no_low)), BAND - 1))
        out = along.bitwiseOR(edits.bitwiseAND(F.lit(every)))
        for _ in range(THRESHOLD):
            out = deletions(out)
        return out

    def matches(at: Column) -> Column:
        """For each diagonal whether the characters agree, once for each level."""
        out = F.lit(0)
        for d in range(BAND):
            out = out + F.when(F.get(a, at + (d - THRESHOLD)) == F.get(b, at), copies << d).otherwise(0)
        return out

    # Deletions before the first character reach diagonal e with e edits, and all levels above keep what lower ones reach.
    start = sum(1 << (BAND * e + THRESHOLD + d) for e in range(levels) for d in range(e + 1))
    end = F.aggregate(F.transform(F.sequence(F.lit(0), F.size(b) - 1), matches), F.lit(start), step)
    if not whole:
        return end != 0
    goal = F.size(a) - F.size(b) + THRESHOLD + BAND * THRESHOLD
    return F.call_function("shiftrightunsigned", end, goal).bitwiseAND(F.lit(1)) == 1


def near(line: Column, other: Column, length: Column, other_length: Column) -> Column:
    """Whether two lines are within THRESHOLD edits: by Spark's own distance up to a limit, whose time grows with the square of the length, else by bands."""
    short = F.greatest(length, other_length) <= MAX_PLAIN
    return F.when(short, F.levenshtein(line, other, THRESHOLD) >= 0).otherwise(near_by_bands(line, other, length, other_length))


def near_by_bands(line: Column, other: Column, length: Column, other_length: Column) -> Column:
    """Whether two lines are within THRESHOLD edits, in time that grows with their length.

    What the lines begin and end with alike, in whole parts of the shorter one, is left out. Lines that part early are told apart by
    the characters around the first difference; the others are compared whole.
    """
    shorter = F.least(length, other_length)
    part = lambda i: (shorter * i / PREFIXES).cast("int")
    alike = lambda most, cut: F.size(F.filter(F.sequence(F.lit(0), most), lambda i: (i > 0) & (cut(line, part(i)) == cut(other, part(i)))))
    ahead = alike(F.lit(PREFIXES - 1), lambda x, n: F.substring(x, F.lit(1), n))
    # Bound by lambdas, so that each step is taken once for a pair wherever Spark moves the condition. One part is always left.
    begun = F.transform(F.array(ahead), lambda i: F.struct(i.alias("i"), alike(PREFIXES - 1 - i, F.right).alias("j")))
    middle = lambda x, n, c: F.slice(F.split(x, ""), part(c["i"]) + 1, n - part(c["i"]) - part(c["j"]))
    rest = F.transform(begun, lambda c: F.struct(middle(line, length, c).alias("a"), middle(other, other_length, c).alias("b")))
    reach = (shorter / PREFIXES).cast("int") + 24
    return F.exists(rest, lambda x: within(F.slice(x["a"], F.lit(1), reach + THRESHOLD), F.slice(x["b"], F.lit(1), reach), whole=False) & within(x["a"], x["b"]))


def later_of_linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``lid`` of the later line of each pair (``a``, ``b``) that is linked."""
    both = pairs.join(texts.alias("x"), F.col("a") == F.col("x.lid")).join(texts.alias("y"), F.col("b") == F.col("y.lid")).where(may_link("x", "y"))
    late = F.when(F.col("x.pos") < F.col("y.pos"), F.col("b")).otherwise(F.col("a"))
    return materialize(both.where(near(F.col("x.line"), F.col("y.line"), F.col("x.len"), F.col("y.len"))).select(late.alias("lid")).distinct(), "late")


def open_families(met: DataFrame, late: DataFrame) -> DataFrame:
    """``key``, ``lid``, ``own``, ``open`` (not late): the lines of keys in which an open line still has another to meet.

    A leader has met all lines of its key, so it is left out: a family of copies of its leader is done after the first round, however large.
    """
    rows = met.where("lid <> lead").groupBy("key", "lid").agg(F.max("own").alias("own"))
    rows = materialize(rows.join(late.withColumn("late", F.lit(True)), "lid", "left").select("key", "lid", "own", F.col("late").isNull().alias("open")), "marked")
    keys = rows.groupBy("key").agg(F.max("own").alias("indexed"), F.max("open").alias("any"), F.count("*").alias("n")).where("indexed and any and n > 1")
    out = materialize(rows.join(keys.select("key"), "key", "left_semi"), "family")
    discard(rows)
    return out


def sub_keys(rows: DataFrame, about: DataFrame) -> DataFrame:
    """Rows of a key, once for each group of letters: ``sub`` also tells the counts of that group."""
    cut = [round(i * len(LETTERS) / GROUPS) for i in range(GROUPS + 1)]
    masks = [sum(15 << 4 * k for k in range(cut[g], cut[g + 1])) for g in range(GROUPS)]
    masks = [m - (1 << 64) if m >> 63 else m for m in masks]
    subs = F.array(*[F.xxhash64("key", F.lit(g), F.col("sig").bitwiseAND(F.lit(m))) for g, m in enumerate(masks)])
    return rows.join(about, "lid").select("*", F.explode(subs).alias("sub"))


def pieces(line: Column, offsets: range) -> Column:
    """Hashes of the stretches of PIECE characters that begin at these offsets from a multiple of PIECE, with the number of the piece.

    The number is that of the multiple next to the beginning, which a piece moved by up to PIECE / 2 characters keeps.
    """
    def cut(offset: int) -> Column:
        found = F.regexp_extract_all(F.substring(line, offset + 1, 2**31 - 1), F.lit(f"(?s).{{{PIECE}}}"), F.lit(0))
        return F.transform(found, lambda x, k: F.xxhash64(x, k + int(offset > PIECE // 2)))

    return F.concat(*[cut(o) for o in offsets])


def pairs_of_large(members: DataFrame, late: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) of lines of a large family (``key``, ``lid``, ``own``) that share a piece which is among the rarest of one.

    One of a pair is not ``late``. Pieces that all share are counted by partial sums, and only rare ones have two sides in the join.
    """
    def cut(rows: DataFrame, offsets: range) -> DataFrame:
        lines = texts.select("lid", "len", "sig", "sketch", pieces(F.col("line"), offsets).alias("_pieces"))
        return rows.join(lines, "lid").select("lid", "key", "own", "len", "sig", "sketch", F.explode("_pieces").alias("_p")).withColumn("sub", F.xxhash64("key", "_p")).drop("_p")

    aligned = cut(members, range(1))
    often = materialize(aligned.groupBy("sub").agg(F.count("*").alias("n")).where("n > 1"), "often")
    ranked = aligned.join(often, "sub", "left").groupBy("key", "lid").agg(
        *[F.first(c).alias(c) for c in ("own", "len", "sig", "sketch")], F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "sub"))).alias("subs"))
    rarest = ranked.select("lid", "own", "len", "sig", "sketch", F.explode(F.slice("subs", 1, THRESHOLD + 1)["sub"]).alias("sub"))
    probes = cut(members.join(late, "lid", "left_anti"), range(PIECE))
    met = (F.col("u.sub") == F.col("v.sub")) & (F.col("u.lid") != F.col("v.lid")) & (F.col("u.own") | F.col("v.own")) & may_link("u", "v")
    pairs = probes.alias("u").join(rarest.alias("v"), met).select(F.least("u.lid", "v.lid").alias("a"), F.greatest("u.lid", "v.lid").alias("b"))
    out = materialize(pairs.distinct(), "pairs")
    discard(often)
    return out


def later_lines(lines: DataFrame) -> DataFrame:
    """``lid`` of the lines that are linked to an earlier one."""
    long = lines.where(F.col("len") >= MIN_CHARS)
    # Only hashes and numbers are shuffled to find candidates.
    leaders = index_rows(long).groupBy("key").agg(F.min(F.struct("id", "lid")).alias("first"), F.count("*").alias("n"))
    leaders = leaders.select("key", F.col("first.lid").alias("lead"), (F.col("n") > 1).alias("many"), (F.col("n") > MAX_FAMILY).alias("large"))
    met = probe_rows(long).join(leaders, "key").where(F.col("many") | ((F.col("who") != F.col("lead")) & (F.col("who") != F.bitwise_not("lead"))))
    met = materialize(met.select("key", F.greatest("who", F.bitwise_not("who")).alias("lid"), (F.col("who") < 0).alias("own"), "lead", "many", "large"), "met")
    pairs = materialize(met.where("lid <> lead").select(F.least("lid", "lead").alias("a"), F.greatest("lid", "lead").alias("b")).distinct(), "pairs")
    # Texts are fetched only for lines that met one: by their numbers where these are few, else by one shuffle of the lines.
    ids = materialize(met.select("lid").union(met.select("lead")).distinct(), "ids")
    text = long.join(F.broadcast(ids) if ids.count() <= MAX_BROADCAST_LINES else ids, "lid", "left_semi")
    texts = materialize(text.select("lid", "pos", "line", "len", letter_counts(F.col("line")).alias("sig"), pair_sketch(F.col("line")).alias("sketch")), "texts")
    late = later_of_linked(pairs, texts)
    # Where a key has one indexed line, that is its leader, and all its pairs have been compared by now.
    about = texts.select("lid", "pos", "len", "sig", "sketch")
    family = open_families(met.where("many and not large"), late)
    open_ = family.where("open")
    earlier = (F.col("v.pos") < F.col("u.pos")) & may_link("u", "v")
    found = []
    for left, right in ((open_, family.where("own")), (open_.where("own"), family.where("not own"))):
        same = (F.col("u.sub") == F.col("v.sub")) & (F.col("u.key") == F.col("v.key")) & (F.col("u.lid") != F.col("v.lid"))
        met_too = sub_keys(left, about).alias("u").join(sub_keys(right, about).alias("v"), same & earlier)
        found.append(met_too.select(F.least("u.lid", "v.lid").alias("a"), F.greatest("u.lid", "v.lid").alias("b")))
    members = met.where("large").groupBy("key", "lid").agg(F.max("own").alias("own"))
    split = pairs_of_large(members, late, texts)
    more = materialize(found[0].union(found[1]).union(split).distinct(), "pairs")
    out = materialize(late.union(later_of_linked(more, texts)).distinct(), "late")
    discard(met, pairs, ids, texts, late, family, split, more)
    return out


def kept_lines(docs: DataFrame) -> DataFrame:
    """``_i``, ``_h``, ``keep``: the numbers of the worded lines that each document keeps."""
    lines = distinct_lines(docs)
    late = later_lines(lines)
    # The first place of a line stays unless an earlier line is linked to it; every other place goes.
    first = lines.select("lid", "pos").join(late, "lid", "left_anti")
    keep = first.groupBy("pos.id", "pos.h").agg(F.collect_set("pos.n").alias("keep")).select(doc_key(F.col("id")).alias("_i"), F.col("h").alias("_h"), "keep")
    keep = materialize(keep, "keep")
    discard(late, lines)
    return keep


def doc_key(key: Column) -> Column:
    """The id as text; none is told from an empty one."""
    return F.when(key.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), key.cast("string")))


def _deduped(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_doc`` (the row), ``_new`` (its text without repeated lines), ``_n``, ``_removed``; one row for each row of ``docs``."""
    text_of = F.col(f"`{text}`")
    known = [F.xxhash64(F.coalesce(text_of, F.lit(""))).alias("_h")]
    keep = kept_lines(docs.select(F.col(f"`{key}`").alias("_id"), *known, text_of.alias("_text")))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), doc_key(F.col(f"`{key}`")).alias("_i"), *known)
    joined = own.join(keep, ["_i", "_h"], "left")
    split = joined.withColumn("_lines", F.split(F.col(f"_doc.`{text}`"), "\n"))
    plain = F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), lambda i: ~F.get("_lines", i).rlike(r"[\p{L}\p{N}]"))
    kept = F.transform(F.sort_array(F.concat(F.coalesce("keep", F.array().cast("array<int>")), plain)), lambda i: F.get("_lines", i))
    done = split.withColumn("_kept", F.when(F.col("_lines").isNotNull(), kept))
    n = F.coalesce(F.size("_lines"), F.lit(0))
    return done.select("_doc", F.array_join("_kept", "\n").alias("_new"), n.alias("_n"), F.coalesce(F.size("_lines") - F.size("_kept"), F.lit(0)).alias("_removed"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` with the text's repeated lines removed, and n_lines and n_removed (in place of columns of these names)."""
    columns = [(F.col("_new") if c == text else F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    return _deduped(docs, key, text).select(*columns, F.col("_n").alias("n_lines"), F.col("_removed").alias("n_removed"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_removed").cast("long").alias("n_removed"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its own columns, without the lines that occur earlier; ``n_chars`` follows the text where there is one."""
    new = {"text": F.col("_new"), "n_chars": F.length("_new")}
    return _deduped(docs, "doc_id", "text").select(*[(new[f.name].cast(f.dataType) if f.name in new else F.col(f"_doc.`{f.name}`")).alias(f.name) for f in docs.schema.fields])


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, n, ls[n] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS n FROM d)),
marked AS (SELECT *, regexp_matches(line, '[\\p{{L}}\\p{{N}}]') AS worded FROM l),
lines AS (SELECT line, min({{'d': doc_id, 'n': n}}) AS pos, length(line) AS len FROM marked WHERE worded GROUP BY line),
long AS (SELECT * FROM lines WHERE len >= {MIN_CHARS}),
late AS (
  SELECT DISTINCT b.line FROM long a JOIN long b ON b.len BETWEEN a.len - {THRESHOLD} AND a.len + {THRESHOLD} AND a.pos < b.pos
  WHERE levenshtein(a.line, b.line) <= {THRESHOLD}),
kept AS (
  SELECT m.doc_id, m.n, m.line FROM marked m LEFT JOIN lines USING (line)
  WHERE NOT worded OR (pos = {{'d': m.doc_id, 'n': m.n}} AND m.line NOT IN (SELECT line FROM late)))
SELECT d.doc_id, len(ls)::BIGINT AS n_lines, (len(ls) - count(kept.n))::BIGINT AS n_removed,
  sha256(coalesce(string_agg(kept.line, chr(10) ORDER BY kept.n), '')) AS text_sha256
FROM d LEFT JOIN kept USING (doc_id) GROUP BY d.doc_id, ls
"""
