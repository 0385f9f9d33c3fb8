"""Joins by key and by row id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY_BUCKETS = 65_536
HOT_SHARE = 1000  # a bucket is hot above 1/1000 of the rows, so fewer than 1000 buckets can be


def _key_bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS))


def hot_buckets(df: DataFrame, key: str, min_rows: int) -> DataFrame:
    """Key buckets that hold more than 1/HOT_SHARE of the rows and more than ``min_rows``.

    Counting hash buckets instead of keys keeps the shuffled counts, and the result, bounded.
    """
    counts = df.select(_key_bucket(key).alias("_bucket")).groupBy("_bucket").agg(F.count("*").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy())  # over at most KEY_BUCKETS rows
    return (
        counts.withColumn("_limit", F.greatest(total / HOT_SHARE, F.lit(min_rows)))
        .where(F.col("_n") > F.col("_limit"))
        .select("_bucket", F.lit(True).alias("_hot"))
    )


def lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str, id_col: str, how: str = "left",
           hot: DataFrame | None = None, salts: int = 64, min_rows: int = 10_000) -> DataFrame:
    """Many-to-one join on a key of which one value may hold a large part of ``left``.

    ``right`` has at most one row per key; ``id_col`` is unique in ``left``. Left rows of hot buckets are
    spread over ``salts`` partitions by row id, and only those buckets' right rows are replicated
    (under HOT_SHARE of KEY_BUCKETS buckets). ``hot`` is the result of ``hot_buckets``, if several lookups are to share
    one count. Returns the left columns and the right side's other columns.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    hot = F.broadcast(hot_buckets(left, left_key, min_rows) if hot is None else hot)  # < HOT_SHARE rows
    spread = F.when(F.col("_hot"), F.pmod(F.xxhash64(id_col), F.lit(salts))).otherwise(F.lit(0))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_left = left.withColumn("_bucket", _key_bucket(left_key)).join(hot, "_bucket", "left")
    salted_left = salted_left.select(*left.columns, F.col(left_key).alias("_key"), spread.cast("int").alias("_salt"))
    salted_right = right.withColumn("_bucket", _key_bucket(right_key)).join(hot, "_bucket", "left")
    salted_right = salted_right.select(
        *[c for c in right.columns if c != right_key], F.col(right_key).alias("_key"), F.explode(copies).alias("_salt")
    )
    return salted_left.join(salted_right, ["_key", "_salt"], how).drop("_key", "_salt")


def zip_by_id(id_col: str, first: DataFrame, *others: DataFrame, complete: bool = True) -> DataFrame:
    """Tables that describe the same rows side by side, joined on the explicit row id, which is unique in each.

    A row that some table lacks is an error when the result is computed, also where a whole table is empty: a full outer
    join with one marker per table finds it in the same pass. With ``complete=False`` only the common ids are returned
    (``unmatched`` lists the rest). Null ids match nothing.
    """
    if not complete or not others:
        joined = first
        for other in others:
            joined = joined.join(other, id_col)
        return joined
    marks = [f"_in{i}" for i in range(len(others) + 1)]
    joined = first.withColumn(marks[0], F.lit(True))
    for mark, other in zip(marks[1:], others, strict=True):
        joined = joined.join(other.withColumn(mark, F.lit(True)), id_col, "full_outer")
    present = F.lit(True)
    for mark in marks:
        present = present & F.col(mark).isNotNull()
    lacking = F.concat_ws(", ", *[F.when(F.col(m).isNull(), F.lit(f"table {i}")) for i, m in enumerate(marks)])
    message = F.concat(F.lit(f"tables differ in {id_col}: "), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(" is not in "), lacking)
    return joined.where(F.when(present, True).otherwise(F.raise_error(message).cast("boolean"))).drop(*marks)


def unmatched(id_col: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """Ids present on one side only, with the side that lacks them."""
    return (
        left.join(right, id_col, "left_anti").select(id_col, F.lit("right").alias("missing_in"))
        .unionByName(right.join(left, id_col, "left_anti").select(id_col, F.lit("left").alias("missing_in")))
    )
