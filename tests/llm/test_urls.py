"""URL filter against a plain loop."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from qaloom.llm import urls

SCHEMA = "page_id bigint, url string, host string, path string, keys string, rule int, verdict int, listed string"
RULES = "action string, host string, path string"


def lower(s: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = re.search(r"[/?#]", rest)
    host = rest if end is None else rest[: end.start()]
    return lower(host), re.split(r"[?#]", rest[len(host) :])[0]


def page(url):
    host, path = split(url)
    path = path.rstrip("/")
    return (host.removeprefix("www.") + path.removesuffix(".html")) if host else None


def expected(url, rules, listed):
    host, path = split(url)
    fits = [(len(h) + len(p), len(h), a == "block", lower(h) + p) for a, h, p in rules if host and (host == lower(h) or host.endswith("." + lower(h))) and path.startswith(p or "")]
    in_list = page(url) is not None and page(url) in {page(x) for x in listed}
    best = max(fits, default=None)
    blocks = best[2] if best else in_list
    return host, path, best[3] if best else None, in_list, "block" if blocks else "allow"


def data():
    rng = random.Random(6)
    hosts = ["a.net", "net", "x.example.net", "example.net", "EXAMPLE.com", "b.c.example.com", "www.q.org", "org", "fr.org", "notnet", ".net", "h", "example.net:80", "ex@m.net", "İ.net"]
    tails = ["", "/", "/en/", "/en", "/EN/1", "/de/1.html", "/de/1", "/de/1/", "/fr/x?y=/en/", "?q=/", "#/en/", "/en/a#b", "//", "/a/../en/", "/fr/" + "z/" * 3000]
    some = [f"{rng.choice(['http', 'https', '', 'a://b'])}://{h}{t}" for h in hosts for t in tails]
    return some + [None, "", "no scheme", "://", ":///en/", "http://", "http:// net/en/", "http://a.net/\nline"]


ALL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"), ("allow", "Q.org", "/de"),
             ("block", "net", "/"), ("allow", "net", "/"), ("block", "c.example.com", ""), ("block", "", "/"), ("block", None, "/x")]
LISTED = ["https://q.org/de/1", "http://www.fr.org/fr/x.html?z", "http://h", "http://org/en/a", None, "junk", "http://h", "://", "http://fr.org/de/1.html"]


@pytest.mark.parametrize("rules", [ALL_RULES, ALL_RULES[:4], []])
@pytest.mark.parametrize("size", [1, 64 << 20])  # a filter of one block lets nearly everything through to the join
def test_verdicts(spark, rules, size):
    rows = [(i, u, "h", "p", "k", 1, 2, "l") for i, u in enumerate(data())] + [(None, data()[3], "h", "p", "k", 1, 2, "l"), (5, data()[5], "h", "p", "k", 1, 2, "l")]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    listed = spark.createDataFrame([(u,) for u in LISTED], "url string")
    clean = [r for r in rules if r[1]]
    got = urls.filter_urls(pages, spark.createDataFrame(rules, RULES), listed, max_filter_bytes=max(size, urls.BLOCK_BYTES)).collect()
    assert sorted(str(r.page_id) for r in got) == sorted(str(r[0]) for r in rows)
    clean = [(("block" if ("block", *r[1:]) in clean else r[0]), *r[1:]) for r in clean]
    for r in got:
        assert (r.host, r.path, r.rule, r.listed, r.verdict) == expected(r.url, clean, [x for x in LISTED if x]), r.url


def test_empty_tables(spark):
    rules, listed = spark.createDataFrame(ALL_RULES, RULES), spark.createDataFrame([], "url string")
    pages = spark.createDataFrame([(1, "http://a.net/", "h", "p", "k", 1, 2, "l")], SCHEMA)
    assert urls.filter_urls(pages.limit(0), rules, listed).count() == 0
    assert [r.verdict for r in urls.filter_urls(pages, rules.limit(0), listed).collect()] == ["allow"]


def test_filter_has_no_false_negatives_and_few_false_hits(spark):
    keys = spark.range(50_000).select(F.concat(F.lit("key "), "id").alias("key"))
    table = urls.bloom_filter(keys)
    inside = np.array([r.h for r in keys.select(F.xxhash64("key").alias("h")).collect()])
    others = np.array([r.h for r in spark.range(50_000).select(F.xxhash64(F.concat(F.lit("no "), "id")).alias("h")).collect()])
    assert urls.may_contain(table, inside).all() and urls.may_contain(table, others).mean() < 0.01
    assert urls.bloom_filter(keys, max_bytes=1024).nbytes == 1024
    assert urls.bloom_filter(keys.limit(0)).sum() == 0


def test_one_address_and_one_rule_with_most_rows(spark):
    urls_ = F.when(F.col("id") % 3 == 0, F.lit("http://hot.net/")).when(F.col("id") % 3 == 1, F.concat(F.lit("http://s"), "id", F.lit(".net/x"))).otherwise("http://ok.com/1.html")
    pages = spark.range(30_000).select(F.col("id").alias("page_id"), urls_.alias("url"))
    got = urls.filter_urls(pages, spark.createDataFrame(ALL_RULES[:1], RULES), spark.createDataFrame([("http://www.ok.com/1",)], "url string"))
    assert {(r.rule, r.listed, r.verdict, r["count"]) for r in got.groupBy("rule", "listed", "verdict").count().collect()} == {
        ("net/", False, "block", 20_000), (None, True, "block", 10_000)}
