"""Exact positions in a seeded order without a single-task sort.

The order is md5(seed|id), then id. Its first hex digits cut the rows into equal buckets whatever the
ids look like, so "the n-th row" is found by counting rows per bucket (a bounded table), taking
running totals over that table, and sorting only the one bucket in which the n-th row falls. Limits,
samples, splits and early stops then become a comparison with that row: the data itself is neither
sorted nor shuffled. Ids must be unique; equal ids would share a position.

Counts, cuts and ranks are read from a position index (id, position, bucket; ``position_index``), which is stored in
the scratch folder, by default when an operator is called. So however the rows are made, they are computed twice at most:
once for the index, once for the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaloom.operators.dedupe import packed
from qaloom.session import scratch_dir

HEX_DIGITS = 4
MAX_BUCKETS = 16**HEX_DIGITS  # upper bound of every per-bucket table, for any input size


def seeded_key(id_col: str | Column, seed: int = 42) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}|"), c.cast("string")))


def position(id_col: str, seed: int = 42) -> Column:
    """Comparable position of a row: (md5 key, id)."""
    return F.struct(seeded_key(id_col, seed).alias("key"), F.col(id_col).alias("id"))


def position_number(id_col: str, seed: int = 42) -> Column:
    """The first 120 bits of the row's md5 key as a number: sorts like ``position`` and suits hash aggregates."""
    key = seeded_key(id_col, seed)
    halves = [F.conv(F.substring(key, start, 15), 16, 10).cast("bigint") for start in (1, 16)]
    return packed((halves[0], 60), (halves[1], 60))


def _bucket(key: Column) -> Column:
    return F.substring(key, 1, HEX_DIGITS)


def _bucket_totals(rows: DataFrame, by: list[str]) -> DataFrame:
    """Per bucket: its row count, the rows before it and the group's total."""
    counts = rows.groupBy(*by, F.col("_b")).agg(F.count("*").alias("_n"))
    running = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select(
        *by,
        "_b",
        "_n",
        (F.sum("_n").over(running) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("_total"),
    )


def _keyed(df: DataFrame, id_col: str, seed: int, by: list[str]) -> DataFrame:
    pos = position(id_col, seed)
    return df.select(*by, pos.alias("_pos")).withColumn("_b", _bucket(F.col("_pos.key")))


def position_index(df: DataFrame, id_col: str, seed: int = 42, by: tuple[str, ...] = ()) -> DataFrame:
    """Stored narrow table with every row's position and bucket (and group); runs one job over ``df``."""
    rows = _keyed(df, id_col, seed, list(by))
    path = scratch_dir(df.sparkSession, "positions")
    rows.write.parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def nth_positions(index: DataFrame, sizes: dict[str, Column | int]) -> DataFrame:
    """One row: ``total`` and, per named size n, the position of the n-th row of a position index.

    A size may be an expression over ``total``. Its position is null where n exceeds the row count.
    """
    rows = index
    totals = _bucket_totals(rows, [])
    wanted = F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), (F.lit(n) if isinstance(n, int) else n).cast("bigint").alias("n"))
        for name, n in sizes.items()
    ]))
    targets = (
        totals.withColumnRenamed("_total", "total")
        .select("_b", "_n", "_before", "total", wanted.alias("_w"))
        .where((F.col("_w.n") > F.col("_before")) & (F.col("_w.n") <= F.col("_before") + F.col("_n")))
        .select("_b", F.col("_w.name").alias("_name"), (F.col("_w.n") - F.col("_before")).alias("_at"))
    )
    # at most one bucket per named size, so this broadcast has len(sizes) rows
    inside = rows.join(F.broadcast(targets), "_b").withColumn(
        "_rn", F.row_number().over(Window.partitionBy("_name", "_b").orderBy("_pos"))
    )
    return inside.where(F.col("_rn") == F.col("_at")).agg(*[
        F.max(F.when(F.col("_name") == name, F.col("_pos"))).alias(name) for name in sizes
    ])


def at_or_before(df: DataFrame, id_col: str, n: int, seed: int = 42, where: Column | None = None) -> Column:
    """Predicate for the row's own table: its position is not after the n-th row that meets ``where``.

    True everywhere when fewer than n rows meet it. ``df`` is a stored narrow table; it is read, not indexed.
    """
    if n <= 0:
        return F.lit(False)
    counted = df.where(where) if where is not None else df
    return _not_after(_keyed(counted, id_col, seed, []), id_col, n, seed)


def _not_after(index: DataFrame, id_col: str, n: int, seed: int) -> Column:
    last = nth_positions(index, {"last": n}).select("last").scalar()
    return last.isNull() | (position(id_col, seed) <= last)


def keep_first(df: DataFrame, id_col: str, n: int, seed: int = 42, by: tuple[str, ...] = (),
               index: DataFrame | None = None) -> DataFrame:
    """Exactly min(n, rows) rows in seeded order, per group if ``by`` is given."""
    if n <= 0:
        return df.where(F.lit(False))
    index = position_index(df, id_col, seed, by) if index is None else index
    if not by:
        return df.where(_not_after(index, id_col, n, seed))
    keys = list(by)
    rows = index
    totals = _bucket_totals(rows, keys)
    cuts = _group_cuts(rows, totals, keys, n)
    # joined on (group, bucket), so one group with most of the rows still spreads over all buckets; where the
    # limits turn out small, adaptive execution broadcasts them
    limits = _null_safe_join(totals.where(F.col("_before") < n).select(*keys, "_b"), cuts, keys)
    limited = _null_safe_join(df.withColumn("_b", _bucket(seeded_key(id_col, seed))), limits, [*keys, "_b"])
    return limited.where(F.col("_last").isNull() | (position(id_col, seed) <= F.col("_last"))).select(*df.columns)


def _group_cuts(rows: DataFrame, totals: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Per group the position of its n-th row as ``_last``; null for groups with at most n rows."""
    crossing = (F.col("_before") < n) & (F.col("_before") + F.col("_n") >= n) & (F.col("_total") > n)
    at = totals.where(crossing).select(*keys, "_b", (n - F.col("_before")).alias("_at"))
    ranked = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy("_pos"))
    last = (
        _null_safe_join(rows, at, [*keys, "_b"]).withColumn("_rn", ranked).where(F.col("_rn") == F.col("_at"))
        .select(*keys, F.col("_pos").alias("_last"))
    )
    whole = totals.where(F.col("_total") <= n).select(*keys).distinct()
    return last.unionByName(whole, allowMissingColumns=True)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys that may be null; returns the left columns and the right side's others."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, on).drop(*[f"_right_{k}" for k in keys])


def global_rank(df: DataFrame, id_col: str, seed: int = 42, name: str = "rank", first: int | None = None,
                index: DataFrame | None = None) -> DataFrame:
    """Exact 1-based rank of every row in seeded order: rank in the bucket plus the rows before it.

    Ranks are made on the index and joined to the rows by id; with ``first`` only rows up to that rank are returned.
    """
    index = position_index(df, id_col, seed) if index is None else index
    totals = _bucket_totals(index, []).select("_b", "_before")
    if first is not None:
        totals = totals.where(F.col("_before") < first)
    in_bucket = F.row_number().over(Window.partitionBy("_b").orderBy("_pos"))
    ranked = index.join(F.broadcast(totals), "_b").withColumn(name, in_bucket + F.col("_before"))  # <= MAX_BUCKETS rows
    if first is not None:
        ranked = ranked.where(F.col(name) <= first)
    return df.join(ranked.select(F.col("_pos.id").alias(id_col), name), id_col).select(*df.columns, name)


def running_sum(df: DataFrame, by: list[str], chunk: str, order: str, value: Column, name: str) -> DataFrame:
    """Inclusive running sum per group, computed per ordered ``chunk`` of the group.

    Each chunk is summed on its own; the sum of the earlier chunks is added. A group with most of the
    rows is therefore as many tasks as it has chunks.
    """
    valued = df.withColumn("_v", value)
    chunk_sums = valued.groupBy(*by, chunk).agg(F.sum("_v").alias("_s"))
    earlier = Window.partitionBy(*by).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunk_sums.select(*by, chunk, F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*by, chunk).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        valued.withColumn("_in", F.sum("_v").over(inside))
        .join(offsets, [*by, chunk])
        .withColumn(name, F.col("_in") + F.col("_offset"))
        .select(*df.columns, name)
    )


def with_next(df: DataFrame, by: str, order: str, cols: dict[str, str], width: int = 4096) -> DataFrame:
    """Adds, for every ``new: col`` in ``cols``, the column's value in the group's next row.

    Rows are handled in chunks of ``width`` consecutive order values (integers >= 0), so that a group
    holding a large part of the table is still many tasks; the last row of a chunk takes the first
    row of the group's next chunk.
    """
    chunk = [by, "_c"]
    chunked = df.withColumn("_c", F.floor(F.col(order) / width))
    payload = F.struct(*[F.col(c).alias(new) for new, c in cols.items()])
    rows = chunked.withColumn("_next", F.lead(payload).over(Window.partitionBy(*chunk).orderBy(order)))
    # which chunk follows which: narrow columns only
    ahead = F.lead("_c").over(Window.partitionBy(by).orderBy("_c"))
    follows = chunked.select(*chunk).distinct().select(*chunk, ahead.alias("_ahead")).where(F.col("_ahead").isNotNull())
    # chunk 0 follows none, so groups shorter than ``width`` read nothing here (a pushed-down filter)
    heads = (
        chunked.where(F.col(order) >= width).groupBy(*chunk).agg(F.min_by(payload, order).alias("_head"))
        .withColumnRenamed("_c", "_ahead")
    )
    following = follows.join(heads, [by, "_ahead"]).drop("_ahead")
    return (
        rows.join(following, chunk, "left")
        .withColumn("_next", F.coalesce("_next", "_head"))
        .select(*df.columns, *[F.col(f"_next.{new}").alias(new) for new in cols])
    )
