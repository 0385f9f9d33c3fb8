import hashlib
import random

import pytest
from pyspark.sql import functions as F

from qaloom.operators import dedupe, order


def key(i, seed=42):
    return hashlib.md5(f"{seed}|{i}".encode()).hexdigest(), i


def ids(df, col="id"):
    return {r[col] for r in df.select(col).collect()}


@pytest.mark.parametrize("n", [-1, 0, 1, 7, 199, 200, 500])
def test_keep_first_is_exactly_the_head_of_the_seeded_order(spark, n):
    expected = set(sorted(range(200), key=key)[:max(n, 0)])
    assert ids(order.keep_first(spark.range(200), "id", n)) == expected
    assert ids(order.keep_first(spark.range(200).repartition(7), "id", n)) == expected


def test_another_seed_gives_another_order(spark):
    assert ids(order.keep_first(spark.range(200), "id", 20, seed=1)) == set(sorted(range(200), key=lambda i: key(i, 1))[:20])


def test_keep_first_by_group_with_one_dominant_group(spark):
    df = spark.range(600).withColumn("g", F.when(F.col("id") % 10 == 0, F.col("id") % 4).when(F.col("id") % 25 == 1, None).otherwise(9))
    got = order.keep_first(df, "id", 25, by=("g",)).groupBy("g").agg(F.collect_set("id").alias("ids")).collect()
    groups = {}
    for i in range(600):
        groups.setdefault(i % 4 if i % 10 == 0 else None if i % 25 == 1 else 9, []).append(i)
    assert {r.g: set(r.ids) for r in got} == {g: set(sorted(m, key=key)[:25]) for g, m in groups.items()}


def test_keep_first_by_group_covers_a_limit_on_a_bucket_border(spark, monkeypatch):
    monkeypatch.setattr(order, "HEX_DIGITS", 1)
    df = spark.range(64).withColumn("g", F.lit("a"))
    for n in range(1, 65, 9):
        assert ids(order.keep_first(df, "id", n, by=("g",))) == set(sorted(range(64), key=key)[:n])


def test_conditional_position_counts_only_flagged_rows(spark):
    df = spark.range(300)
    flagged = [i for i in sorted(range(300), key=key) if i % 3 == 0]
    last = flagged[9]
    expected = {i for i in range(300) if key(i) <= key(last)}
    assert ids(df.where(order.at_or_before(df, "id", 10, where=F.col("id") % 3 == 0))) == expected
    assert df.where(order.at_or_before(df, "id", 101, where=F.col("id") % 3 == 0)).count() == 300


def test_global_rank(spark):
    got = {r.id: r["rank"] for r in order.global_rank(spark.range(500).repartition(5), "id").collect()}
    assert got == {i: n + 1 for n, i in enumerate(sorted(range(500), key=key))}


def test_running_sum_over_chunks(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 5 else "cold", i // 13, i, rng.randint(-2, 4)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, chunk int, pos int, v int").repartition(6)
    got = {r.pos: r.total for r in order.running_sum(df, ["g"], "chunk", "pos", F.col("v"), "total").collect()}
    sums, expected = {}, {}
    for g, _, pos, v in rows:
        sums[g] = sums.get(g, 0) + v
        expected[pos] = sums[g]
    assert got == expected


@pytest.mark.parametrize("width", [1, 3, 10, 4096])
def test_next_row_across_chunks_and_gaps(spark, width):
    rng = random.Random(width)
    rows = [(g, t, f"{g}-{t}") for g in range(4) for t in sorted(rng.sample(range(60), rng.randint(1, 40)))]
    df = spark.createDataFrame(rows, "g int, t int, v string").repartition(5)
    got = {(r.g, r.t): r.nxt for r in order.with_next(df, "g", "t", {"nxt": "v"}, width=width).collect()}
    expected = {}
    for (g, t, _), after in zip(rows, rows[1:] + [(None, None, None)]):
        expected[g, t] = after[2] if after[0] == g else None
    assert got == expected


def test_first_seen_and_last_written(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("aaab"), None if i % 3 else f"v{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "i int, k string, v string").repartition(4)
    first = {(r.k, r.i, r.v) for r in dedupe.first_seen(df, "k", F.col("i")).collect()}
    last = {(r.k, r.i, r.v) for r in dedupe.last_written(df, "k", F.col("i")).collect()}
    assert first == {min((i, k, v) for i, k, v in rows if k == c)[1:2] + min((i, "", v or "") for i, k, v in rows if k == c)[0:1]
                     + (min(((i, v) for i, k, v in rows if k == c), key=lambda x: x[0])[1],) for c in "ab"}
    assert last == {(c, *max(((i, v) for i, k, v in rows if k == c), key=lambda x: x[0])) for c in "ab"}
    again = dedupe.first_seen(dedupe.first_seen(df, "k", F.col("i")), "k", F.col("i"))
    assert {(r.k, r.i, r.v) for r in again.collect()} == first
