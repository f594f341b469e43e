"""URL filters: a blocked Bloom filter in front of an exact hash join.

A list holds keys ``host/path-prefix``: rules, which are matched as they stand, and entries, which are canonical. A
URL is looked up by its expressions, every host suffix crossed with every path prefix that a listed key can have (of the URL
as it stands and in canonical form), so the work for a URL depends on its own length and on the distinct numbers of labels and prefix lengths in the
list, never on the list's size; a host of very many labels costs no more than its length for each listed number. The Bloom filter drops the expressions that are certainly not listed before anything
is shuffled; what passes goes to an exact join with the list, so a false positive of the filter never reaches the result.

Defined cases: a null URL and one without ``://`` have empty host and path and fit nothing; an empty
list or table gives no hits; repeated listed keys count once; repeated rows of the input are judged
each; only the key and the URL are read, so other columns may have any name, and ``judge_urls`` returns none of them.
"""

from __future__ import annotations

from bisect import bisect_right
from urllib.parse import quote, unquote_to_bytes

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read

#: The contract's rules: host, path prefix, verdict.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Hosts of the synthetic tables that publish nothing but advertising; listed with all their pages.
LISTED = ("spam-farm.example.org/", "spam-farm.example.com/", "spam-farm.example.net/", "cheap-pills.example.com/", "cheap-pills.example.org/", "cheap-pills.example.net/")
#: Further entries of the default list, made by rule: hosts of their own, the odd ones with a path.
GENERATED = 100_000
BLOCK_WORDS = 4  # 64-bit words of a block: one 256-bit block holds all probes of a key
PROBES = 6
BITS_PER_KEY = 16
MAX_FILTER_BYTES = 32 << 20  # the filter is broadcast; a longer list gets fewer bits a key, never a larger filter


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: str, path: str) -> tuple[str, str]:
    """Host without user, port and trailing dots; path with percent codes in one form and dot segments resolved."""
    host = host.rpartition("@")[2].lower()
    if not host.endswith("]"):
        host = host.partition(":")[0] if host.count(":") == 1 else host
    host = host.strip(".")
    out: list[str] = []
    for part in path.split("/")[1:]:
        if part == "..":
            out = out[:-1]
        elif part != ".":
            out.append(quote(unquote_to_bytes(part), safe="-._~!$&'()*+,;=:@") if "%" in part else part)
    if path.endswith(("/.", "/..")):
        out.append("")
    return host, "/" + "/".join(out) if path else "/"


class BlockedBloom:
    """Each key sets PROBES bits within one block, so a lookup touches one cache line."""

    def __init__(self, n_keys: int):
        size = max(1, n_keys * BITS_PER_KEY // (64 * BLOCK_WORDS))
        self.blocks = 1 << min(int(size - 1).bit_length(), (MAX_FILTER_BYTES // (8 * BLOCK_WORDS)).bit_length() - 1)
        self.words = np.zeros((self.blocks, BLOCK_WORDS), np.uint64)

    def _place(self, hashes: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        block = (hashes >> np.uint64(32)) & np.uint64(self.blocks - 1)
        out, h = [], hashes.copy()
        for _ in range(PROBES):
            h = h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
            bit = h >> np.uint64(56)
            out.append((bit >> np.uint64(6), np.uint64(1) << (bit & np.uint64(63))))
        return block, out

    def add(self, hashes: np.ndarray) -> None:
        block, bits = self._place(hashes)
        for word, bit in bits:
            np.bitwise_or.at(self.words, (block, word), bit)

    def might_hold(self, hashes: np.ndarray) -> np.ndarray:
        block, bits = self._place(hashes)
        hit = np.ones(len(hashes), bool)
        for word, bit in bits:
            hit &= (self.words[block, word] & bit) != 0
        return hit


def _hashes(keys) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k.encode()) for k in keys), np.uint64)


def build_filter(listed: DataFrame) -> BlockedBloom:
    """Partial filters are built where the list lies and merged by OR; the driver sees bounded bitmaps only."""
    bloom = BlockedBloom(listed.count())

    def part(batches):
        own = BlockedBloom(0)
        own.blocks, own.words = bloom.blocks, np.zeros((bloom.blocks, BLOCK_WORDS), np.uint64)
        for pdf in batches:
            own.add(_hashes(pdf["key"]))
        flat = own.words.ravel()
        at = np.flatnonzero(flat)
        import pandas as pd

        yield pd.DataFrame({"word": at.astype(np.int64), "bits": flat[at].view(np.int64)})

    words = listed.select("key").mapInPandas(part, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # MAX_FILTER_BYTES twice at most
    bloom.words.reshape(-1)[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return bloom


def expressions(host: str, path: str, prefix_lengths: list[int], label_counts: list[int]) -> list[str]:
    """Keys under which a URL can be listed: the host's suffixes of a listed number of labels, each with each prefix of the path of a listed length (both in order)."""
    labels = host.rsplit(".", label_counts[-1]) if label_counts else []
    hosts = [".".join(labels[-n:]) if n < len(labels) else host for n in label_counts if n <= len(labels)]
    fits = prefix_lengths[: bisect_right(prefix_lengths, len(path))]
    return [h + path[:n] for h in hosts for n in fits]


def judge_urls(pages: DataFrame, listed: DataFrame, url: str = "url", key: str = "page_id") -> DataFrame:
    """Look up every URL in ``listed`` (host, path, verdict, rule: a rule's verdict goes before a plain entry's).

    Returns ``key``, host, path, rule, verdict; one row for each row of ``pages``.
    """
    spark = pages.sparkSession
    # Rules and entries are matched alike; a rule's key may also be listed as an entry.
    listed = listed.select(F.concat("host", "path").alias("key"), F.length("path").alias("path_n"), F.size(F.split("host", r"\.")).alias("labels"), "verdict", F.col("is_rule").cast("boolean").alias("is_rule")).where("key is not null").dropDuplicates(["key", "is_rule"])
    shape = listed.select("is_rule", "path_n", "labels").distinct().collect()
    ways = [(kind, *(sorted({r[k] for r in shape if r["is_rule"] == is_rule}) for k in ("path_n", "labels"))) for kind, is_rule in (("r", True), ("e", False))]
    bloom = spark.sparkContext.broadcast(build_filter(listed))
    base = pages.select(F.col(key), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))

    def passing(batches):
        import pyarrow as pa

        filt = bloom.value
        for batch in batches:
            keys, at = [], []
            for i, (h, p) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if h:
                    own = [(k, kind) for kind, lengths, counts in ways for k in expressions(*((h, p) if kind == "r" else canonical(h, p)), lengths, counts)]
                    keys += own
                    at += [i] * len(own)
            hits: list[list[str]] = [[] for _ in range(batch.num_rows)]
            if keys:
                for j in np.flatnonzero(filt.might_hold(_hashes([k for k, _ in keys]))):
                    hits[at[j]].append("".join(reversed(keys[j])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, pa.list_(pa.string()))], [key, "host", "path", "maybe"])

    shape = T.StructType([*base.schema.fields, T.StructField("maybe", T.ArrayType(T.StringType()))])
    probed = base.mapInArrow(passing, shape)
    return _exact(probed, listed, key)


def _exact(probed: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Join the distinct possible keys with the list, then look the confirmed ones up by URL.

    URLs without a possible hit leave by the first branch and are never shuffled.
    """
    maybe = F.size("maybe") > 0
    miss = probed.where(~maybe).select(key, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    # A hot host is one distinct (host, hit list) however many of its pages there are: decide once for each.
    hit = probed.where(maybe)
    groups = hit.select("maybe").groupBy("maybe").agg(F.lit(1).alias("one")).select("maybe", F.explode("maybe").alias("way"))
    groups = groups.select("maybe", F.expr("substring(way, 2)").alias("key"), F.col("way").startswith("r").alias("is_rule"))
    # Rules are met by the URL as it stands, entries by its canonical form; the longest rule wins, then an entry blocks.
    found = groups.join(listed, ["key", "is_rule"]).groupBy("maybe").agg(
        F.max(F.when(F.col("is_rule"), F.struct(F.length("key").alias("n"), F.col("key"), F.col("verdict")))).alias("best"),
        F.bool_or(~F.col("is_rule")).alias("entry"),
    )
    keyed = found.select(F.array_join("maybe", "\n").alias("_m"), "best", "entry")
    judged = hit.withColumn("_m", F.array_join("maybe", "\n")).join(keyed, "_m", "left").select(
        key,
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.when(F.col("entry"), F.lit("block")), F.lit("allow")).alias("verdict"),
    )
    return miss.unionByName(judged)


def default_list(spark: SparkSession) -> DataFrame:
    rows = [(h, p, v, True) for h, p, v in RULES] + [(k[: k.index("/")], k[k.index("/") :], "block", False) for k in LISTED]
    made = spark.range(GENERATED).selectExpr("concat('listed-', id, '.example.', element_at(array('com', 'net', 'org'), cast(id % 3 as int) + 1)) AS host", "if(id % 2 = 1, concat('/p/', id % 50, '/'), '/') AS path", "'block' AS verdict", "false AS is_rule")
    return spark.createDataFrame(rows, "host string, path string, verdict string, is_rule boolean").unionByName(made)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"), default_list(spark))


_HOST = "CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END"
_PATH = "CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END"
#: Entries are met by the host without user, port and trailing dots; the paths of the generated entries stand on hosts of their own.
_CANONICAL = "trim(regexp_replace(regexp_replace(host, '^.*@', ''), '^([^:]*):[^:]*$', '\\1'), '.')"
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce({_HOST}, '') AS host, coalesce({_PATH}, '') AS path FROM pages),
c AS (SELECT *, {_CANONICAL} AS plain, CASE WHEN path = '' THEN '/' ELSE path END AS whole FROM p),
rules(h, p, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
entries(h, p) AS (SELECT * FROM (VALUES {", ".join(f"('{k[: k.index('/')]}', '{k[k.index('/') :]}')" for k in LISTED)}) UNION ALL
  SELECT 'listed-' || i || '.example.' || (['com', 'net', 'org'])[i % 3 + 1], CASE WHEN i % 2 = 1 THEN '/p/' || (i % 50) || '/' ELSE '/' END FROM range({GENERATED}) t(i)),
parts AS (SELECT page_id, plain, whole, string_split(plain, '.') AS labels FROM c WHERE host <> ''),
suffixes AS (SELECT page_id, whole, array_to_string(list_slice(labels, s, len(labels)), '.') AS h FROM (SELECT *, unnest(range(1, len(labels) + 1)) AS s FROM parts)),
listed AS (SELECT DISTINCT page_id FROM suffixes JOIN entries USING (h) WHERE starts_with(whole, p)),
fits AS (SELECT page_id, host, path, (SELECT max({{'n': length(h || r.p), 'rule': h || r.p, 'v': v}}) FROM rules r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, r.p)) AS best FROM c)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.v, CASE WHEN page_id IN (SELECT page_id FROM listed) THEN 'block' ELSE 'allow' END) AS verdict FROM fits
"""
