import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from qaloom.operators import splits


def sizes(df):
    return {r.split: r.n_rows for r in splits.split_counts(df).collect()}


@pytest.mark.parametrize("n, test, validation, expected", [
    (1000, 100, 50, {"train": 900, "validation": 50, "test": 50}),
    (9995, None, None, {"train": 7496, "validation": 625, "test": 1874}),
    (40, 20, None, {"train": 20, "validation": 5, "test": 15}),
    (3, 2, 1, {"train": 1, "validation": 1, "test": 1}),
])
def test_sizes_are_exact(spark, n, test, validation, expected):
    got = splits.split_exact(spark.range(n), "id", test, validation)
    assert sizes(got) == expected == splits.expected_sizes(n, test, validation)


def test_same_rows_for_any_partitioning(spark):
    def assigned(df):
        return {r.id: r.split for r in splits.split_exact(df, "id", 60, 20).collect()}

    assert assigned(spark.range(300)) == assigned(spark.range(300).repartition(11)) == assigned(spark.range(300).coalesce(1))


@pytest.mark.parametrize("test, validation", [(500, 500), (100, 0), (50, 60)])
def test_impossible_sizes_are_refused(spark, test, validation):
    with pytest.raises(ValueError):
        splits.split_exact(spark.range(1000), "id", test, validation)
    with pytest.raises(ValueError):
        splits.expected_sizes(1000, test, validation)


def test_a_pool_as_large_as_the_table_is_refused(spark):
    # raised inside a subquery, which reaches Python as the plain Java error
    with pytest.raises(Exception, match="validation < test < rows"):
        splits.split_exact(spark.range(100), "id", 100, 10).collect()


def test_existing_split_is_kept_and_checked(spark):
    df = spark.range(4).withColumn("split", F.lit("train"))
    assert sizes(splits.split_table(df, "id", 2, 1)) == {"train": 4}
    with pytest.raises(PySparkException, match="unknown split"):
        splits.split_table(df.withColumn("split", F.lit("dev")), "id").collect()
    assert sizes(splits.split_table(spark.range(8), "id", 4, 1)) == {"train": 4, "test": 3, "validation": 1}


def test_verify_reports_sizes_and_shared_ids(spark):
    df = spark.createDataFrame([(1, "train"), (1, "test"), (2, "train"), (3, "validation")], "id int, split string")
    got = {r.split: r for r in splits.split_verify(df, "id", {"train": 2, "validation": 5, "test": None}).collect()}
    assert [(got[s].n_rows, got[s].sizes_agree) for s in ("train", "validation", "test")] == [(2, True), (1, False), (1, True)]
    assert {r.ids_in_several_splits for r in got.values()} == {1}


def test_union_skips_missing_and_refuses_none(spark):
    parts = {"train": spark.range(3), "validation": None, "test": spark.range(10, 12)}
    with pytest.warns(UserWarning, match="validation"):
        assert splits.union_splits(parts, ["train", "validation", "test"]).count() == 5
    with pytest.warns(UserWarning), pytest.raises(ValueError):
        splits.union_splits(parts, ["validation"])


def test_limits_and_samples(spark):
    ranks = [r["rank"] for r in splits.shuffle_limit(spark.range(50), "id", 8).orderBy("rank").collect()]
    assert ranks == list(range(1, 9))
    assert splits.oversample_limit(spark.range(50), "id", 10, 2).count() == 20
    assert splits.oversample_limit(spark.range(15), "id", 10, 2).count() == 15
    assert splits.oversample_limit(spark.range(15), "id", None, 2).count() == 15
    head = splits.sample_head(spark.range(9).withColumn("text", F.lit("x")), "id", 3, drop=("text",))
    assert [r.asDict() for r in head.collect()] == [{"id": 0}, {"id": 1}, {"id": 2}]
