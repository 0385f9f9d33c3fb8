"""Exact-size train/validation/test assignment, checks, unions and samples."""

from __future__ import annotations

import warnings
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.operators.order import global_rank, keep_first, nth_positions, position, position_index

SPLITS = ("train", "validation", "test")
DEFAULT_SHARE = 0.25  # pool and validation share where no size is configured


def _pool_and_validation(total: Column, test: int | None, validation: int | None) -> tuple[Column, Column]:
    """First a pool of ``test`` rows is cut, then ``validation`` rows out of that pool."""
    pool = F.lit(test).cast("bigint") if test is not None else F.ceil(total * DEFAULT_SHARE)
    val = F.lit(validation).cast("bigint") if validation is not None else F.ceil(pool * DEFAULT_SHARE)
    return pool, val


def expected_sizes(total: int, test: int | None = None, validation: int | None = None) -> dict[str, int]:
    """Sizes the split rule gives for a table of ``total`` rows; raises where it cannot be met."""
    pool = test if test is not None else ceil(total * DEFAULT_SHARE)
    val = validation if validation is not None else ceil(pool * DEFAULT_SHARE)
    if not 0 < val < pool < total:
        raise ValueError(f"need 0 < validation < test < rows, got {val}, {pool}, {total}")
    return {"train": total - pool, "validation": val, "test": pool - val}


def split_exact(df: DataFrame, id_col: str, test: int | None = None, validation: int | None = None,
                seed: int = 42, index: DataFrame | None = None) -> DataFrame:
    """Adds ``split``; exact sizes, same result for any partitioning of the input.

    The rows themselves are not shuffled: two cut positions are found from the position index (made here unless it is
    given) and every row is compared with them.
    """
    if test is not None and validation is not None and not 0 < validation < test:
        raise ValueError(f"need 0 < validation < test, got {validation}, {test}")
    pool, val = _pool_and_validation(F.col("total"), test, validation)
    feasible = (F.lit(0) < val) & (val < pool) & (pool < F.col("total"))
    problem = F.raise_error(F.lit("need 0 < validation < test < rows"))
    pool = F.when(feasible, pool).otherwise(problem.cast("bigint"))
    cuts = nth_positions(position_index(df, id_col, seed) if index is None else index, {"validation": val, "pool": pool})
    cut = cuts.select(F.struct("validation", "pool").alias("cut")).scalar()
    pos = position(id_col, seed)
    return df.withColumn(
        "split",
        F.when(pos <= cut["validation"], "validation").when(pos <= cut["pool"], "test").otherwise("train"),
    )


def split_table(df: DataFrame, id_col: str, test: int | None = None, validation: int | None = None,
                seed: int = 42) -> DataFrame:
    """Keeps an existing three-way split as it is, otherwise splits."""
    if "split" not in df.columns:
        return split_exact(df, id_col, test, validation, seed)
    return split_passthrough(df)


def split_passthrough(df: DataFrame) -> DataFrame:
    """Rows of a pre-split table; a split name outside train/validation/test is an error."""
    unknown = F.raise_error(F.concat(F.lit("unknown split: "), F.coalesce("split", F.lit("null")))).cast("string")
    return df.withColumn("split", F.when(F.col("split").isin(*SPLITS), F.col("split")).otherwise(unknown))


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n_rows"))


def split_verify(df: DataFrame, id_col: str, expected: dict[str, int | None]) -> DataFrame:
    """Per split: declared and actual rows, whether they agree, and ids that occur in several splits."""
    per_id = df.groupBy(id_col).agg(F.min("split").alias("_lo"), F.max("split").alias("_hi"))
    shared = per_id.where(F.col("_lo") != F.col("_hi")).agg(F.count("*").alias("n")).scalar()
    declared = F.create_map(*[F.lit(x) for kv in expected.items() for x in kv])
    names = F.explode(F.array(*[F.lit(s) for s in expected])).alias("split")
    spark = df.sparkSession
    return (
        spark.range(1).select(names)
        .join(split_counts(df), "split", "left")
        .select(
            "split",
            F.element_at(declared, F.col("split")).cast("bigint").alias("declared_rows"),
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            shared.alias("ids_in_several_splits"),
        )
        .withColumn("sizes_agree", F.coalesce(F.col("declared_rows") == F.col("n_rows"), F.lit(True)))
    )


def union_splits(parts: dict[str, DataFrame | None], wanted: list[str]) -> DataFrame:
    """Concatenation of the wanted splits; a missing one is skipped with a warning, none is an error."""
    present = []
    for name in wanted:
        if parts.get(name) is None:
            warnings.warn(f"split {name!r} not found, skipping", stacklevel=2)
        else:
            present.append(parts[name])
    if not present:
        raise ValueError(f"none of the splits {wanted} found")
    out = present[0]
    for part in present[1:]:
        out = out.unionByName(part)
    return out


def shuffle_limit(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """The first n rows in seeded order, with their 1-based ``rank``."""
    return global_rank(df, id_col, seed, first=n)


def oversample_limit(df: DataFrame, id_col: str, limit: int | None, factor: int, seed: int = 42) -> DataFrame:
    """Candidates for a job that will keep ``limit`` rows: min(limit * factor, rows)."""
    return df if limit is None else keep_first(df, id_col, limit * factor, seed)


def sample_cap(df: DataFrame, id_col: str, cap: int = 4000, seed: int = 42, by: tuple[str, ...] = ()) -> DataFrame:
    """All rows of a group that has at most ``cap``, otherwise exactly ``cap`` of them."""
    return keep_first(df, id_col, cap, seed, by)


def sample_head(df: DataFrame, id_col: str, n: int = 5, drop: tuple[str, ...] = ()) -> DataFrame:
    """The n rows with the smallest ids, optionally without some columns (a top-k report)."""
    return df.orderBy(id_col).limit(n).drop(*drop)
