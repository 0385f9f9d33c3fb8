"""Dataset profile: rows, sizes, token statistics, histograms, sequence budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.functions.text import token_count, words
from qaloom.operators.splits import sample_cap
from qaloom.session import scratch_dir


def length_table(df: DataFrame, texts: dict[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    """``by..., text, tokens, n``: how many rows have which token length, for several texts in one pass.

    ``texts`` maps a name to the column of its token counts. The table is bounded by the distinct lengths, so all later
    statistics (median, totals, bins) run on a small table. Tables of parts of the data are merged by ``merge_lengths``.
    """
    each = [F.struct(F.lit(name).alias("text"), tokens.cast("bigint").alias("tokens")) for name, tokens in texts.items()]
    counted = df.select(*by, F.explode(F.array(*each)).alias("_l")).select(*by, "_l.text", "_l.tokens")
    return counted.groupBy(*by, "text", "tokens").agg(F.count("*").alias("n"))


def store_lengths(lengths: DataFrame, path: str | None = None) -> DataFrame:
    """The length table as stored Parquet, by default in the scratch folder: one pass over the texts for all reports."""
    spark = lengths.sparkSession
    path = scratch_dir(spark, "lengths") if path is None else path
    lengths.write.mode("overwrite").parquet(path)
    return spark.read.schema(lengths.schema).parquet(path)


def merge_lengths(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One length table of several with the same groups."""
    merged = first
    for other in others:
        merged = merged.unionByName(other)
    keys = [c for c in first.columns if c != "n"]
    return merged.groupBy(*keys).agg(F.sum("n").alias("n"))


def _stats(weight: str = "n") -> list[Column]:
    """Means are rounded half to even, as Python rounds."""
    total, rows = F.sum(F.col("tokens") * F.col(weight)), F.sum(weight)
    return [
        rows.alias("n_tokenized"),
        total.alias("total_tokens_in_sample"),
        F.bround(total / rows, 1).alias("avg"),
        F.min("tokens").alias("min"),
        F.max("tokens").alias("max"),
        F.percentile("tokens", F.lit(0.5), F.col(weight)).alias("median"),
    ]


STATS = ("n_tokenized", "total_tokens_in_sample", "avg", "min", "max", "median")


def text_stats(lengths: DataFrame, texts: list[str], by: tuple[str, ...] = (), rows: DataFrame | None = None) -> DataFrame:
    """Per group and text: rows, tokenized rows, whether that is a sample, tokens in it, the estimate for all rows, mean,
    extremes and median. ``rows`` (group, n_rows) says how many rows there are, if the lengths are of a sample. Groups, and
    without groups texts, that have no rows at all get zeros."""
    keys = [*by, "text"]
    stats = lengths.groupBy(*keys).agg(*_stats())
    names = F.explode(F.array(*[F.lit(t) for t in texts])).alias("text")
    if rows is not None:
        stats = rows.withColumn("text", names).join(stats, keys, "left")
    elif by:
        stats = stats.withColumn("n_rows", F.col("n_tokenized"))
    else:
        all_texts = lengths.sparkSession.range(1).select(names)
        stats = all_texts.join(stats, keys, "left").withColumn("n_rows", F.coalesce("n_tokenized", F.lit(0)))
    per_row = F.col("total_tokens_in_sample") / F.nullif(F.col("n_tokenized"), F.lit(0))
    return stats.withColumns({c: F.coalesce(c, F.lit(0)) for c in STATS}).select(
        *keys,
        "n_rows",
        "n_tokenized",
        (F.col("n_rows") > F.col("n_tokenized")).alias("is_estimate"),
        "total_tokens_in_sample",
        F.coalesce(F.floor(per_row * F.col("n_rows")), F.lit(0)).cast("bigint").alias("est_total_tokens"),
        "avg",
        "min",
        "max",
        "median",
    )


def profile_texts(df: DataFrame, texts: list[str] | dict[str, Column], id_col: str, by: tuple[str, ...] = (), cap: int | None = None,
                  seed: int = 42, method: str = "whitespace") -> DataFrame:
    """``text_stats`` of several text columns of a table, over all rows or, with ``cap``, over that many sampled rows of
    each group at most. ``texts`` are column names, or maps a name to a column of token counts."""
    counts = texts if isinstance(texts, dict) else {c: token_count(F.col(c), method) for c in texts}
    if cap is None:
        return text_stats(length_table(df, counts, by), list(counts), by)
    rows = df.groupBy(*by).agg(F.count("*").alias("n_rows"))
    return text_stats(length_table(sample_cap(df, id_col, cap, seed, by), counts, by), list(counts), by, rows)


def token_stats(df: DataFrame, col: str, id_col: str, by: tuple[str, ...] = (), cap: int | None = None,
                seed: int = 42, method: str = "whitespace", tokens: Column | None = None) -> DataFrame:
    """Token statistics of one text per group over all rows, or with ``cap`` over that many sampled rows of each at most.

    ``tokens`` may be any integer column expression instead of ``method``, e.g. ``tokenizing.tokenizer_count``.
    """
    counts = {col: token_count(F.col(col), method) if tokens is None else tokens}
    return profile_texts(df, counts, id_col, by, cap, seed).drop("text")


def profile(df: DataFrame, col: str, dataset: str = "dataset", split: str = "split",
            method: str = "whitespace") -> DataFrame:
    """Rows, column count and token statistics per dataset and split, with totals per dataset and overall.

    The roll-up runs on the length table, not on the data.
    """
    lengths = length_table(df, {col: token_count(F.col(col), method)}, (dataset, split))
    return (
        lengths.rollup(dataset, split).agg(*_stats())
        .withColumnRenamed("n_tokenized", "n_rows")
        .withColumnRenamed("total_tokens_in_sample", "total_tokens")
        .withColumn("n_columns", F.lit(len(df.columns)))
    )


def size_mb(spark: SparkSession, path: str, *by: str) -> DataFrame:
    """Files and bytes / 1e6 of a Parquet table, per group of partition columns; from the file listing, no data is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(*by, "length")
    return files.groupBy(*by).agg(F.count("*").alias("n_files"), F.bround(F.sum("length") / 1e6, 2).alias("size_mb"))


def histogram(df: DataFrame, col: str, bins: int = 40, method: str = "whitespace") -> DataFrame:
    """Equal-width bins between the shortest and longest length; the last bin includes the maximum.

    One row per bin (empty ones too) with its edges, count, and the mean of all lengths; no rows for an empty table.
    """
    lengths = store_lengths(length_table(df, {col: token_count(F.col(col), method)}))
    lo, hi = F.min("tokens").cast("double"), F.max("tokens").cast("double")
    # a single distinct length gets a range of one around it
    same = F.when(lo == hi, 0.5).otherwise(0.0)
    edges = lengths.agg((lo - same).alias("lo"), (hi + same).alias("hi"), (F.sum(F.col("tokens") * F.col("n")) / F.sum("n")).alias("mean"))
    edge = edges.select(F.struct("lo", "hi", "mean")).scalar()
    width = (edge["hi"] - edge["lo"]) / bins
    in_bin = F.least(F.floor((F.col("tokens") - edge["lo"]) * bins / (edge["hi"] - edge["lo"])), F.lit(bins - 1)).cast("int")
    counts = lengths.groupBy(in_bin.alias("bin")).agg(F.sum("n").alias("n_rows"))
    all_bins = lengths.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).where(edge["lo"].isNotNull())
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (edge["lo"] + F.col("bin") * width).alias("bin_from"),
        (edge["lo"] + (F.col("bin") + 1) * width).alias("bin_to"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.round(edge["mean"], 6).alias("mean"),
    )


def len_budget(df: DataFrame, col: str, max_tokens: int) -> DataFrame:
    """Adds ``n_tokens``, ``over_budget`` and the text cut to its first ``max_tokens`` words."""
    tokens = words(F.coalesce(col, F.lit("")))
    marked = df.withColumn("n_tokens", F.size(tokens)).withColumn("over_budget", F.col("n_tokens") > max_tokens)
    shortened = F.array_join(F.slice(tokens, 1, max_tokens), " ")
    return marked.withColumn(col, F.when(F.col("over_budget"), shortened).otherwise(F.col(col)))


def len_budget_report(budgeted: DataFrame, *by: str) -> DataFrame:
    return budgeted.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.count_if("over_budget").alias("n_over"),
        F.round(F.avg(F.col("over_budget").cast("int")), 6).alias("share_over"),
    )
