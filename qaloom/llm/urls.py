"""URL filters: a blocked Bloom filter over the listed keys, then an exact hash join for what may be listed."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.llm.common import store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = 8  # 32-bit words of one block; a key sets one bit in each
BLOCK_BYTES = 4 * WORDS
# odd 32-bit multipliers, one per word: multiples of the golden ratio's fraction
SALTS = [((i + 1) * 0x9E3779B97F4A7C15 >> 31) & 0xFFFFFFFF | 1 for i in range(WORDS)]


def host_of(url: Column) -> Column:
    """From behind the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty or beginning with ``/``."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """One spelling for the usual variants of an address: no scheme, query or fragment, no ``www.`` before the host, no
    slashes or ``.html`` at the end of the path. Null where there is no host."""
    bare = F.when(F.startswith(host, F.lit("www.")), F.substr(host, F.lit(5))).otherwise(host)
    trimmed = F.rtrim(path, F.lit("/"))
    page = F.when(F.endswith(trimmed, F.lit(".html")), F.substr(trimmed, F.lit(1), F.length(trimmed) - 5)).otherwise(trimmed)
    return F.when(host != "", F.concat(bare, page))


def _n_labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def entries(rules: DataFrame, listed: DataFrame, listed_col: str) -> DataFrame:
    """The list under its keys, each once: rules (their host and path) and whole canonical URLs. Where a rule is given
    with both actions it blocks."""
    host = F.translate("host", UPPER, LOWER)
    prefixes = rules.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), (F.col("action") == "block").alias("blocks"))
    prefixes = prefixes.where("host <> ''").groupBy("host", "path").agg(F.max(F.coalesce("blocks", F.lit(False))).alias("blocks"))
    url = listed.select(F.col(listed_col).alias("url"))
    whole = url.select(canonical(host_of(F.col("url")), path_of(F.col("url"))).alias("page")).dropna().distinct()
    return prefixes.select(F.concat(F.lit("rule "), "host", "path").alias("key"), "host", "path", "blocks").unionByName(
        whole.select(F.concat(F.lit("page "), "page").alias("key")), allowMissingColumns=True
    )


def candidates(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys under which a URL could be listed: its canonical form, and its last labels and first path characters in
    every shape (number of labels, path length) that some rule has."""
    rules = [
        F.when((_n_labels(host) >= n) & (F.length(path) >= m) & (host != ""), F.concat(F.lit("rule "), F.substring_index(host, ".", -n), F.substr(path, F.lit(1), F.lit(m))))
        for n, m in shapes
    ]
    keys = F.array(F.concat(F.lit("page "), canonical(host, path)), *rules)
    return F.filter(keys, lambda k: k.isNotNull())


def _places(key_hash: Column, n_blocks: int) -> tuple[Column, list[Column]]:
    block = F.shiftright(F.shiftrightunsigned(key_hash, 32) * F.lit(n_blocks).cast("bigint"), 32)
    low = key_hash.bitwiseAND(F.lit(0x7FFFFFFF))
    return block, [F.shiftright((low * F.lit(s).cast("bigint")).bitwiseAND(F.lit(0xFFFFFFFF)), 27) for s in SALTS]


def bloom_filter(keys: DataFrame, *, bits_per_key: int = 16, max_bytes: int = 64 << 20) -> np.ndarray:
    """Filter over the column ``key``: one row of eight 32-bit words per block.

    Blocks are put together by a grouped bit-wise or, so the driver receives each block once. The size follows the number
    of keys up to ``max_bytes``; beyond it the filter passes more false hits, which the join removes.
    """
    n_blocks = max(1, min(ceil(keys.count() * bits_per_key / (8 * BLOCK_BYTES)), max_bytes // BLOCK_BYTES))
    block, bits = _places(F.xxhash64("key"), n_blocks)
    placed = keys.select(block.alias("block"), *[b.cast("int").alias(f"b{i}") for i, b in enumerate(bits)])
    words = [F.bit_or(F.expr(f"shiftleft(1L, b{i})")).alias(f"w{i}") for i in range(WORDS)]
    rows = placed.groupBy("block").agg(*words).toArrow()
    table = np.zeros((n_blocks, WORDS), np.uint32)
    at = rows.column("block").to_numpy()
    for i in range(WORDS):
        table[at, i] = rows.column(f"w{i}").to_numpy().astype(np.uint32)
    return table


def may_contain(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter may hold the keys with these 64-bit hashes; one cache line is read per key."""
    unsigned = hashes.view(np.uint64)
    block = ((unsigned >> np.uint64(32)) * np.uint64(len(table))) >> np.uint64(32)
    low, found = unsigned & np.uint64(0x7FFFFFFF), np.ones(len(hashes), bool)
    line = table[block.astype(np.int64)]
    for i, salt in enumerate(SALTS):
        bit = ((low * np.uint64(salt)) & np.uint64(0xFFFFFFFF)) >> np.uint64(27)
        found &= (line[:, i] >> bit.astype(np.uint32)) & np.uint32(1) == 1
    return found


def _probe(spark, table: np.ndarray):
    """Column function: for arrays of key hashes, arrays of whether the filter may hold them."""
    shared = spark.sparkContext.broadcast(table)

    def probe(hashes: pa.Array) -> pa.Array:
        sizes = hashes.value_lengths().to_numpy(zero_copy_only=False)
        found = may_contain(shared.value, hashes.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
        ends = np.cumsum(sizes)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(found))

    return F.arrow_udf(probe, returnType=T.ArrayType(T.BooleanType()))


def filter_urls(
    pages: DataFrame, rules: DataFrame, listed: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
    listed_col: str = "url", bits_per_key: int = 16, max_filter_bytes: int = 64 << 20,
) -> DataFrame:
    """``page_id, url, host, path, rule, listed, verdict`` for every row of ``pages``.

    ``rules`` (host, path, action allow or block) fit their host and its subdomains where the URL's path starts with the
    rule's; of several the longest decides (host and path counted together, then the longer host). Where none fits, the
    page is blocked just if its canonical URL is in ``listed``, else allowed.

    Every URL is looked up under a few keys in a broadcast Bloom filter of at most ``max_filter_bytes``. URLs without a
    possible hit are settled there, in the row. The others' distinct addresses and keys are joined with the list, which
    removes false hits, and the verdicts go back to the rows by address; the list itself is never broadcast by us. A rule
    or address that most pages share is one key of these joins, which adaptive execution splits.

    Null or schemeless URLs have empty host and path and are allowed. Null ids, repeated rows and rows of equal URLs are
    returned as often as they come, with equal verdicts; other columns are ignored. Empty lists allow everything. Rules
    without a host, and listed rows without one, fit nothing.
    """
    spark = pages.sparkSession
    known = store(entries(rules, listed, listed_col), "listed")
    # how many labels and path characters rules have: a few numbers, whatever the length of the list
    shaped = known.where(F.col("host").isNotNull()).select(_n_labels(F.col("host")).alias("n"), F.length("path").alias("m"))
    shapes = sorted((r.n, r.m) for r in shaped.distinct().collect())
    probe = _probe(spark, bloom_filter(known.select("key"), bits_per_key=bits_per_key, max_bytes=max_filter_bytes))

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rows = rows.withColumn("keys", candidates(F.col("host"), F.col("path"), shapes))
    rows = rows.withColumn("found", probe(F.transform("keys", lambda k: F.xxhash64(k))))
    rows = rows.withColumn("keys", F.filter("keys", lambda k, i: F.get("found", i))).drop("found")
    probed = store(rows, "probed")

    hits = probed.select("host", "path", F.explode("keys").alias("key")).distinct()
    rule = F.struct(
        (F.length("r.host") + F.length("r.path")).alias("size"), F.length("r.host").alias("labels"), "r.blocks",
        F.concat("r.host", "r.path").alias("rule"),
    )
    exact = hits.alias("h").join(known.alias("r"), F.col("h.key") == F.col("r.key")).select(
        "h.host", "h.path", F.when(F.col("r.host").isNotNull(), rule).alias("rule"), F.col("r.host").isNull().alias("listed")
    )
    settled = exact.groupBy("host", "path").agg(F.max("rule").alias("best"), F.max("listed").alias("listed"))
    some = F.size("keys") > 0
    joined = probed.where(some).drop("keys").join(settled, ["host", "path"], "left")
    open_ = probed.where(~some).select(*[c for c in joined.columns if c not in ("best", "listed")])
    return joined.unionByName(open_, allowMissingColumns=True).select(
        "page_id", "url", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("listed", F.lit(False)).alias("listed"),
        F.when(F.coalesce(F.col("best.blocks"), F.col("listed"), F.lit(False)), "block").otherwise("allow").alias("verdict"),
    )
