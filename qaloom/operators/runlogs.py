"""Training-run metrics in long form: (stage, session, step, metric, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CURVE_METRICS = ("loss", "eval_loss", "learning_rate")
REWARD_METRICS = ("rewards/chosen", "rewards/rejected", "rewards/margins")


def metric_rows(df: DataFrame, metrics: tuple[str, ...] = ("loss", "eval_loss")) -> DataFrame:
    """Log entries (one map of metrics per row) that report at least one of the metrics."""
    wanted = F.lit(False)
    for m in metrics:
        wanted = wanted | F.map_contains_key("metrics", m)
    return df.where(wanted)


def _latest(df: DataFrame) -> Column:
    """What orders the reports of one step: session, then time stamp (where there is one), then the larger value."""
    return F.struct("session", *(["ts"] if "ts" in df.columns else []), "value")


def last_session(df: DataFrame, key: tuple[str, ...] = ("stage",)) -> DataFrame:
    """One value per (key, step, metric): that of the last session that reported it."""
    return df.groupBy(*key, "step", "metric").agg(F.max(_latest(df))["value"].alias("value"))


def run_curves(df: DataFrame, metrics: tuple[str, ...] = CURVE_METRICS, key: tuple[str, ...] = ("stage",)) -> DataFrame:
    """One row per step with a column per metric; restarts resolved to the last session.

    One shuffle: the last session is picked per metric inside the aggregate that also pivots.
    """

    def latest(metric: str):
        is_metric = F.col("metric") == metric
        return F.max(F.when(is_metric, _latest(df)))["value"].alias(metric)

    return df.where(F.col("metric").isin(*metrics)).groupBy(*key, "step").agg(*[latest(m) for m in metrics])


def best_checkpoint(df: DataFrame, key: tuple[str, ...] = ("stage",), metric: str = "eval_loss") -> DataFrame:
    """Step with the smallest metric (the earliest of equals), and the latest step."""
    series = last_session(df, key)
    is_metric = F.col("metric") == metric
    return series.groupBy(*key).agg(
        F.min(F.when(is_metric, F.struct("value", "step"))).alias("_best"),
        F.max(F.when(is_metric, F.col("step"))).alias("last_eval_step"),
        F.max("step").alias("latest_step"),
    ).select(*key, F.col("_best.step").alias("best_step"), F.col("_best.value").alias(f"best_{metric}"),
             "last_eval_step", "latest_step")


def keep_last(df: DataFrame, n: int = 2, key: tuple[str, ...] = ("stage",), metric: str = "eval_loss") -> DataFrame:
    """Checkpoints to retain: the newest n and the best one.

    The rank filter is pushed below the shuffle, so each task sends at most n rows per stage.
    """
    checkpoints = last_session(df.where(F.col("metric") == metric), key).drop("metric")
    newest = (
        checkpoints.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("step"))))
        .where(F.col("_rn") <= n)
        .select(*key, "step", "value")
    )
    best = checkpoints.groupBy(*key).agg(F.min(F.struct("value", "step")).alias("_b")).select(
        *key, F.col("_b.step").alias("step"), F.col("_b.value").alias("value")
    )
    reasons = newest.withColumns({"newest": F.lit(1), "best": F.lit(0)}).unionByName(
        best.withColumns({"newest": F.lit(0), "best": F.lit(1)})
    )
    return reasons.groupBy(*key, "step").agg(
        F.max("value").alias(metric),
        (F.max("newest") == 1).alias("is_newest"),
        (F.max("best") == 1).alias("is_best"),
    )


def session_counts(df: DataFrame, key: tuple[str, ...] = ("stage",)) -> DataFrame:
    """Per session: rows, first and last step, and steps that a later session reported again."""
    per_step = df.groupBy(*key, "step", "session").agg(F.count("*").alias("n"))
    final = per_step.groupBy(*key, "step").agg(F.max("session").alias("_last"))
    return (
        per_step.join(final, [*key, "step"])
        .groupBy(*key, "session")
        .agg(
            F.sum("n").alias("n_rows"),
            F.min("step").alias("first_step"),
            F.max("step").alias("last_step"),
            F.count_if(F.col("session") < F.col("_last")).alias("superseded_steps"),
        )
    )


def run_summary(df: DataFrame, key: tuple[str, ...] = ("stage",)) -> DataFrame:
    """First, last and mean loss, first, best and last evaluation loss, and run time in seconds."""
    series = df.groupBy(*key, "step", "metric").agg(
        F.max(_latest(df))["value"].alias("value"), F.min("ts").alias("_from"), F.max("ts").alias("_to")
    )

    def at(pick, metric: str):
        chosen = F.when(F.col("metric") == metric, F.struct("step", "value"))
        return pick(chosen)["value"]

    def only(metric: str):
        return F.when(F.col("metric") == metric, F.col("value"))

    return series.groupBy(*key).agg(
        at(F.min, "loss").alias("first_loss"),
        at(F.max, "loss").alias("last_loss"),
        F.round(F.avg(only("loss")), 6).alias("mean_loss"),
        at(F.min, "eval_loss").alias("first_eval_loss"),
        F.min(only("eval_loss")).alias("best_eval_loss"),
        at(F.max, "eval_loss").alias("last_eval_loss"),
        F.timestamp_diff("SECOND", F.min("_from"), F.max("_to")).alias("run_seconds"),
    )
