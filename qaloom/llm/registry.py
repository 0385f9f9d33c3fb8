"""Registered queries of this subpackage: name -> (spark, folder) -> DataFrame, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.llm import (
    decontaminate, importance, licenses, packing, rules, runs, sharding, simhash, substrings, tokens, toxicity, trie, urls,
)
from qaloom.llm.common import store, table, word_array

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = [f"shard-{i:03d}" for i in range(64)]


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query()
def op1_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op2_token_counts(spark, sf_dir):
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op3_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query()
def op4_quality(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return importance.resample(
        table(spark, sf_dir, "documents"), labels.where("quality = 1").select("doc_id"), share=importance.quality_share(labels)
    )


@query()
def op5_decontamination(spark, sf_dir):
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SLOT_SQL = f"(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % {sharding.TABLE_SIZE})"
_NAMES_SQL = "[" + ", ".join(f"'{s}'" for s in SHARDS) + "]"


@query(f"""WITH t AS (SELECT CAST(string_split('{",".join(map(str, sharding.lookup_table(SHARDS)))}', ',') AS INTEGER[]) AS slots)
SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes, {_SLOT_SQL} AS slot, slots[{_SLOT_SQL} + 1] AS shard,
       {_NAMES_SQL}[slots[{_SLOT_SQL} + 1] + 1] AS shard_name FROM documents, t""")
def op6_sharding(spark, sf_dir):
    return sharding.assign(table(spark, sf_dir, "documents"), SHARDS)


_WORDS_SQL = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_LINES_SQL = r"list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))"


@query(f"""WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS_SQL} AS words, {_LINES_SQL} AS lines FROM documents),
windows AS (SELECT doc_id, i, words[i:i + 7] AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest(range(8)) AS j) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(list_max(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS max_word_chars, CAST(len(lines) AS BIGINT) AS n_lines,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, CAST((CASE WHEN n_words < 20 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
  + (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 4 ELSE 0 END) + (CASE WHEN 10 * n_symbols > 2 * n_words THEN 8 ELSE 0 END)
  + (CASE WHEN 2 * n_dup_lines > n_lines THEN 16 ELSE 0 END) + (CASE WHEN max_word_chars > 1000 THEN 32 ELSE 0 END) AS BIGINT) AS fail_bits FROM m)
SELECT *, fail_bits & 3 <> 0 AS base_failed, fail_bits & 31 = 0 AS kept, 'v2' AS policy FROM b""")
def op7_quality_rules(spark, sf_dir):
    return rules.apply_policy(rules.ledger(table(spark, sf_dir, "documents")))


@query(f"""WITH w AS (SELECT doc_id, {_WORDS_SQL} AS words FROM documents),
windows AS (SELECT doc_id, i, words[i:i + 19] AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w WHERE len(words) >= 20)),
repeats AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS nth FROM windows) WHERE nth > 1),
covered AS (SELECT DISTINCT doc_id, i + j AS pos FROM repeats, (SELECT unnest(range(20)) AS j)),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text FROM placed ANTI JOIN covered USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)""")
def op8_substrings(spark, sf_dir):
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


_TEMPLATE_SHINGLES = {name: licenses.template_shingles(text) for name, text in licenses.TEMPLATES.items()}
_SIZE_CLASSES = licenses.size_classes(len(s) for s in _TEMPLATE_SHINGLES.values())
_TEMPLATE_ROWS = ", ".join(
    f"('{name}', {_SIZE_CLASSES[len(s)][0]}, {_SIZE_CLASSES[len(s)][1]}, [{', '.join(repr(x) for x in s)}])"
    for name, s in _TEMPLATE_SHINGLES.items()
)


@query(f"""WITH templates(license, width, stride, shingles) AS (VALUES {_TEMPLATE_ROWS}),
words AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^a-z0-9]+'), lambda w: w <> '') AS w FROM documents),
shingles AS (SELECT doc_id, len(w) - 4 AS n, i, array_to_string(w[i + 1:i + 5], ' ') AS s FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS i FROM words)),
found AS (SELECT doc_id, n, i, s, license, width, stride, len(shingles) AS t FROM shingles JOIN (SELECT *, unnest(shingles) AS s FROM templates) USING (s)),
windows AS (SELECT *, unnest(range(0, greatest(n - width + stride - 1, 0) + 1, stride)) AS pos FROM found),
shares AS (SELECT doc_id, license, pos, count(DISTINCT s) / t AS containment FROM windows WHERE i >= pos AND i < pos + width GROUP BY doc_id, license, pos, t)
SELECT doc_id, license, max(containment) AS containment, CAST(arg_max(pos, (containment, -pos)) AS BIGINT) AS first_word
FROM shares WHERE containment >= 0.8 GROUP BY doc_id, license""")
def op9_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query()
def op10_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
# Host labels of sites whose pages are listed one by one in the query's block list.
LISTED_SITES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
_SITES = "(^|[.])(" + "|".join(LISTED_SITES) + ")[.]"

_HOST_SQL = f"translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{urls.UPPER}', '{urls.LOWER}')"
_PATH_SQL = "coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '')"
_RULES_SQL = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in URL_RULES)


@query(f"""WITH p AS (SELECT page_id, url, {_HOST_SQL} AS host, {_PATH_SQL} AS path, row_number() OVER () AS n FROM pages),
c AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www[.]', '') || regexp_replace(rtrim(path, '/'), '[.]html\\z', '') END AS page FROM p),
listing AS (SELECT DISTINCT page FROM c WHERE regexp_matches(host, '{_SITES}')),
rules(action, h, s) AS (VALUES {_RULES_SQL}),
fits AS (SELECT n, arg_max(h || s, length(h) + length(s)) AS rule, arg_max(action, length(h) + length(s)) AS action FROM c, rules
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) GROUP BY n)
SELECT page_id, url, host, path, rule, listing.page IS NOT NULL AS listed,
  CASE WHEN action IS NOT NULL THEN action WHEN listing.page IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM c LEFT JOIN fits USING (n) LEFT JOIN listing USING (page)""")
def op11_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    listed = pages.where(urls.host_of(pages["url"]).rlike(_SITES)).select("url")
    rules_table = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return urls.filter_urls(pages, rules_table, listed)


def looped_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where a tenth of the texts, told by a hash of the id, end in a repeated stretch of words."""
    h = F.crc32(F.col("doc_id").cast("string"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    rows = docs.select("doc_id", "text", h.alias("h"), word_array(docs["text"]).alias("words")).withColumn("a", g % F.nullif(n, F.lit(0)))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    looped = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", source(i).cast("int"))), " ")
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), looped).otherwise(F.col("text")).alias("text"))


@query()
def op12_periodic_runs(spark, sf_dir):
    found = runs.periodic_runs(looped_tails(table(spark, sf_dir, "documents")))
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    found = found.withColumn("best", F.array_max(order))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


def with_shared_beginnings(turns: DataFrame, members: DataFrame) -> DataFrame:
    """Numbered turns in which conversation c begins with the first h turns of c - c % 100 and goes on with its own from
    its h-th on; h is a hash of its id modulo 6."""
    h, base = F.crc32(F.col("conv_id").cast("string")) % 6, F.col("conv_id") - F.col("conv_id") % 100
    heads = turns.where("conv_id % 100 = 0 AND idx < 5").withColumnRenamed("conv_id", "base")
    taken = members.select("conv_id", h.alias("h"), base.alias("base")).join(heads, "base").where("idx < h").select(*turns.columns)
    sizes = heads.groupBy("base").agg(F.count("*").alias("n"))
    own = turns.withColumns({"h": h, "base": base}).where("idx >= h").join(sizes, "base", "left")
    moved = F.col("idx") - F.col("h") + F.least(F.col("h"), F.coalesce("n", F.lit(0)))
    return taken.unionByName(own.withColumn("idx", moved).select(*turns.columns))


# CRC-32 of a short ASCII text, bit by bit: 3988292384 is the fixed polynomial.
_CRC_SQL = """xor(list_reduce(list_concat([4294967295], list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


@query(f"""WITH turns AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
  struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS x FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(x ORDER BY i) AS xs, CAST({_CRC_SQL.format('CAST(c AS VARCHAR)')} % 6 AS BIGINT) AS h FROM turns GROUP BY c),
built AS (SELECT a.c, list_concat(coalesce(b.xs[1:a.h], []), a.xs[a.h + 1:]) AS xs FROM own a LEFT JOIN own b ON b.c = a.c - a.c % 100),
prefixes AS (SELECT c, xs, CAST(unnest(range(len(xs) + 1)) AS BIGINT) AS d FROM built),
nodes AS (SELECT xs[1:d] AS p, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(length(any_value(xs[d].t)), 0) AS v,
  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(xs) = d), '')) AS ends_sha256 FROM prefixes GROUP BY 1, 2),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
placed AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (p)),
above AS (SELECT p, v, n_children, unnest(range(d + 1)) AS k FROM placed),
below AS (SELECT p[1:k] AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(v) AS saved FROM above GROUP BY 1)
SELECT a.conv_id, a.d AS depth, b.conv_id AS parent_conv_id, a.n_convs, CAST(a.n_children AS BIGINT) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, a.ends_sha256
FROM placed a JOIN below USING (p) LEFT JOIN nodes b ON a.d > 0 AND b.p = a.p[1:a.d - 1]""")
def op13_prefix_trie(spark, sf_dir):
    turns = store(trie.ordered_turns(table(spark, sf_dir, "conversations")), "turns")
    members = turns.select("conv_id").distinct()
    return trie.trie_nodes(with_shared_beginnings(turns, members), members)
