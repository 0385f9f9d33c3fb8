import pytest
from pyspark.sql import functions as F

from qaloom.operators import joins


@pytest.fixture
def skewed(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 30 == 0, F.lit(None))
                                    .otherwise((F.col("id") % 50).cast("string")).alias("k"))
    right = spark.range(0, 40).select(F.col("id").cast("string").alias("key"), (F.col("id") * 2).alias("v"))
    return left, right.unionByName(spark.createDataFrame([("hot", 777)], "key string, v long"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("min_rows", [50, 10_000])
def test_lookup_equals_a_plain_join(skewed, how, min_rows):
    left, right = skewed
    plain = left.join(right, left.k == right.key, how).drop("key")
    got = joins.lookup(left, right, "k", "key", "id", how, salts=8, min_rows=min_rows)
    assert got.columns == plain.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


def test_only_heavy_buckets_are_hot_and_their_rows_are_spread(spark, skewed):
    left, right = skewed
    assert joins.hot_buckets(left, "k", 100).count() == 1
    assert joins.hot_buckets(left, "k", 10_000).count() == 0
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = joins.lookup(left, right, "k", "key", "id", salts=16, min_rows=50).where("k = 'hot'")
        parts = joined.groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 4 and sum(r["count"] for r in parts) == 2000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_join_by_id_and_unmatched(spark):
    a = spark.range(4).withColumn("x", F.lit("a"))
    b = spark.range(2, 6).withColumn("y", F.lit("b"))
    assert sorted(r.id for r in joins.zip_by_id("id", a, b, complete=False).collect()) == [2, 3]
    for other in (b, b.where("id < 5")):
        with pytest.raises(Exception, match="tables differ in id"):
            joins.zip_by_id("id", a, other).collect()
    empty = b.limit(0)
    for tables in ((a, empty), (empty, a), (a, a.select("id"), empty), (a, spark.createDataFrame([(None, "n")], "id long, z string"))):
        with pytest.raises(Exception, match="tables differ in id"):
            joins.zip_by_id("id", *tables).collect()
        with pytest.raises(Exception, match="tables differ in id"):
            joins.zip_by_id("id", *tables).count()
    assert joins.zip_by_id("id", empty, empty.select("id")).count() == 0
    assert joins.zip_by_id("id", a, a.select("id", F.lit(1).alias("z")), b.select(F.col("id") - 2, "y").toDF("id", "y")).count() == 4
    assert sorted(tuple(r) for r in joins.unmatched("id", a, b).collect()) == [(0, "right"), (1, "right"), (4, "left"), (5, "left")]
