"""Benchmark decontamination: a prefix-filtered set join, in DataFrame functions only.

Every item is cut into windows of WINDOW consecutive words (a shorter item is one window); equal windows count once. The shingles of a window
are its pairs of neighbouring words, ordered by rarity: by their counts over the whole corpus. A document that
contains a window exactly must contain all its shingles, so the necessary prefix of a window is one shingle, its
rarest. Documents and windows join on prefix shingles alone, which leaves nearly true matches only. The shingle's place gives
the window's start; it must fit into the document (length and positional bounds). What is left is verified word by word on the
document's own words. The work is in proportion to the places where a window's rarest shingle stands, also in repetitive texts.

A word is hit if it lies in any occurrence of any window; a document is contaminated if at least one word in
twenty is hit, and one at least.

Defined cases: a null or empty text has no words, so nothing is hit; an item without words has no window; an item
of a single word is matched by that word; repeated item rows count once; repeated document rows get equal results; with
an empty benchmark nothing is hit; an empty table gives no rows; items without an id are ignored; documents without an id
are told from those with an empty one; other columns, whatever their names, pass through, but for those named like the
figures that are added (the pipeline's stage adds none).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, read

WINDOW = 13
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHARE = 20
#: A side is broadcast if it holds at most so many words (about 16 bytes each); beyond that it is joined by shuffle.
MAX_BROADCAST_WORDS = 500_000


def with_words(df: DataFrame, text: str, name: str = "w") -> DataFrame:
    """Add the words of the lower-cased text, in order. Empty strings arise at either end only."""
    df = df.withColumn(name, F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), SEPARATORS))
    df = df.withColumn(name, F.when(F.get(name, F.lit(0)) == "", F.slice(name, 2, F.size(name) - 1)).otherwise(F.col(name)))
    return df.withColumn(name, F.when(F.get(name, F.size(name) - 1) == "", F.slice(name, 1, F.size(name) - 1)).otherwise(F.col(name)))


def shingles(w: str) -> Column:
    """A hash for each pair of neighbouring words; the verification is exact, so a collision costs a comparison only."""
    n = F.size(w) - 1
    return F.when(n > 0, F.zip_with(F.slice(w, 1, F.greatest(n, F.lit(0))), F.slice(w, 2, F.greatest(n, F.lit(0))), lambda a, b: F.xxhash64(a, b))).otherwise(F.array().cast("array<long>"))


def single(w: str) -> Column:
    return F.transform(F.col(w), lambda a: F.xxhash64(a))


def near(df: DataFrame, words: Column | None = None) -> DataFrame:
    """A materialized table as the side of a join: broadcast if it holds at most ``MAX_BROADCAST_WORDS`` words (or rows, if these are of a few numbers)."""
    size = df.count() if words is None else df.agg(F.sum(words.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= MAX_BROADCAST_WORDS else df


def windows(items: DataFrame) -> DataFrame:
    """``wid``, ``win`` (its words), ``of`` (the items that have it): each distinct window once, so a repetitive item has few.

    ``wid`` is a hash; two windows that share one are told apart by their words in the end.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size("iw") - WINDOW, F.lit(0)))
    cut = items.select("item", "iw", F.explode(starts).alias("s")).select("item", F.slice("iw", F.col("s") + 1, WINDOW).alias("win"))
    return cut.groupBy("win").agg(F.sort_array(F.collect_set("item")).alias("of")).select(F.xxhash64("win").alias("wid"), "win", "of")


def prefixes(docs: DataFrame, wins: DataFrame, one: bool) -> DataFrame:
    """``token``, ``wid``, ``off``, ``size``: the rarest shingle of each window and its first place there; windows with one that no document has are out.

    ``one`` gives those of a single word, whose only token is that word.
    """
    tok = single if one else shingles
    placed = wins.where((F.size("win") == 1) if one else (F.size("win") > 1)).select("wid", F.size("win").alias("size"), F.posexplode(tok("win")).alias("off", "token"))
    vocabulary = placed.select("token").distinct()
    counts = with_words(docs, "text").select(F.explode_outer(tok("w")).alias("token")).join(near(vocabulary), "token").groupBy("token").agg(F.count("*").alias("n"))
    ranked = placed.join(counts, "token", "left").groupBy("wid", "size").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "off")).alias("b"))
    return ranked.where("b.n > 0").select("b.token", "wid", "b.off", "size")


def candidates(docs: DataFrame, wins: DataFrame, one: bool) -> DataFrame:
    """``_id``, ``_h``, ``start``, ``wid``: where a window may stand in a document; its prefix does stand there, and it fits in."""
    table = materialize(prefixes(docs, wins, one), "prefix")
    keyed = with_words(docs, "text").withColumn("t", (single if one else shingles)("w"))
    # The size is taken before the array is laid out, or every row would carry the array; and the outer form is used, as
    # for the other one Spark adds a filter on the array's size that computes the words once more. The join drops nulls.
    found = keyed.select("_id", "_h", F.size("w").alias("n"), "t").select("_id", "_h", "n", F.posexplode_outer("t").alias("at", "token")).join(near(table), "token")
    return found.where("at >= off and at - off + size <= n").select("_id", "_h", (F.col("at") - F.col("off")).alias("start"), "size", "wid")


def occurrences(slim: DataFrame, wins: DataFrame) -> DataFrame:
    """``_id``, ``_h``, ``start``, ``size``, ``of``: where windows do stand, word by word on the document's own words."""
    found = candidates(slim, wins, False)
    if not wins.where(F.size("win") == 1).isEmpty():
        found = found.unionByName(candidates(slim, wins, True))
    per = found.groupBy("_id", "_h").agg(F.collect_set(F.struct("start", "size", "wid")).alias("c"))
    per = materialize(per, "candidates")
    # Only documents with candidates are cut into words here, each once.
    own = with_words(slim, "text").join(near(per, F.size("c")), ["_id", "_h"])
    spots = own.select("_id", "_h", F.explode(F.transform("c", lambda x: F.struct(x["start"].alias("start"), x["size"].alias("size"), x["wid"].alias("wid"), F.slice(F.col("w"), x["start"] + 1, x["size"]).alias("own")))).alias("x")).select("_id", "_h", "x.*")
    return spots.join(near(wins, F.size("win")), "wid").where(F.col("own") == F.col("win")).select("_id", "_h", "start", "size", "of")


def figures(found: DataFrame) -> DataFrame:
    """``_id``, ``_h``, ``n_hit`` (words inside any occurrence), ``items``.

    Overlapping occurrences are merged in order of their starts, so a word counts once and a long repetitive text takes one sort.
    """
    start = lambda x: F.struct(x["start"].alias("at"), (x["start"] + x["size"]).alias("end"))
    merged = F.aggregate(
        F.array_sort(F.transform("spots", start)),
        F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end")),
        lambda s, x: F.struct((s["hit"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["at"], s["end"]))).alias("hit"), F.greatest(s["end"], x["end"]).alias("end")),
        lambda s: s["hit"],
    )
    per = found.groupBy("_id", "_h").agg(F.collect_set(F.struct("start", "size")).alias("spots"), F.collect_set("of").alias("of"))
    return per.select("_id", "_h", merged.cast("long").alias("n_hit"), F.sort_array(F.array_distinct(F.flatten("of"))).alias("items"))


FIGURES = ("n_words", "n_hit", "items")


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """All columns of ``docs``, and n_words, n_hit, items (ids of the items hit, as sorted text), in place of columns of these names."""
    columns = [F.col(f"_doc.`{c}`").alias(c) for c in docs.columns if c.lower() not in FIGURES]
    return _judged(docs, items, key, text, item, item_text).select(*columns, "_told.*")


def _judged(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``_doc`` (the row) and ``_told`` (n_words, n_hit, items); one row for each row of ``docs``."""
    iw = with_words(items.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("x")), "x", "iw")
    wins = materialize(windows(iw.where(F.col("item").isNotNull() & (F.size("iw") > 0)).select("item", "iw")), "windows")
    text_of, key_of = F.col(f"`{text}`"), F.col(f"`{key}`")
    ident = [F.when(key_of.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), key_of.cast("string"))).alias("_id"), F.xxhash64(F.coalesce(text_of, F.lit(""))).alias("_h")]
    hit = materialize(figures(occurrences(docs.select(*ident, text_of.alias("text")), wins)), "hit")
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *ident, text_of.alias("_text"))
    joined = with_words(own.join(near(hit, F.size("items") + 1), ["_id", "_h"], "left"), "_text", "_w")
    told = lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    # Told by a generator: a later filter on the figures is then not pushed below it, where it would compute all of them again.
    return joined.select("_doc", F.explode_outer(F.transform(F.array("_w"), told)).alias("_told"))


def contaminated(of: str = "") -> Column:
    return (F.col(of + "n_hit") > 0) & (F.col(of + "n_hit") * SHARE >= F.col(of + "n_words"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated, with the columns they came with."""
    clean = _judged(docs, read(spark, sf_dir, "benchmark")).where(~contaminated("_told."))
    return clean.select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])


_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT DISTINCT item_id, {_WORDS} AS iw FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(iw), {WINDOW}) AS size, list_slice(iw, s, s + least(len(iw), {WINDOW}) - 1) AS win
  FROM (SELECT item_id, iw, unnest(range(1, greatest(len(iw) - {WINDOW - 1}, 1) + 1)) AS s FROM i WHERE len(iw) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
spots AS (
  SELECT doc_id, s, size, list_slice(w, s, s + size - 1) AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT doc_id, s, spots.size, item_id FROM spots JOIN win USING (win)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""
