"""Same operator on evenly spread and on skewed keys (one key holds a third of all rows).

``python bench_skew.py [rows]``: prints seconds per operator and how much the slowest task of the run
exceeds the mean of its stage, for both inputs. Rows are made by Spark and written nowhere.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import functions as F

from qaloom.operators import dedupe, enrich, joins, order, profiling, runlogs, splits
from qaloom.session import build_session


def keyed(spark, rows: int, skewed: bool):
    spread = F.pmod(F.xxhash64("id"), F.lit(max(rows // 8, 1)))
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(spread) if skewed else spread
    return spark.range(0, rows, numPartitions=32).select("id", key.alias("k"))


def dialog(spark, rows: int, skewed: bool):
    """Conversations of 8 turns; skewed: a third of all turns belongs to one conversation."""
    hot = (F.col("id") < rows // 3) if skewed else F.lit(False)
    return spark.range(0, rows, numPartitions=32).select(
        F.when(hot, F.lit(-1)).otherwise(F.floor(F.col("id") / 8)).alias("conv_id"),
        F.when(hot, F.col("id")).otherwise(F.col("id") % 8).alias("turn"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"),
    )


def operators(spark, rows: int, skewed: bool):
    k = keyed(spark, rows, skewed)
    table = spark.range(0, max(rows // 8, 1)).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    metrics = k.select(F.col("k").alias("stage"), F.lit(1).alias("session"), F.col("id").alias("step"),
                       F.lit("eval_loss").alias("metric"), F.rand(1).alias("value"))
    questions = k.select("id", F.concat(F.lit("q"), F.col("k").cast("string")).alias("question"), F.lit("a").alias("answer"))
    found = F.array(F.struct(F.lit("t").alias("title"), F.lit("u").alias("url"), F.lit("c").alias("content")))
    cache = table.select(F.concat(F.lit("q"), F.col("key").cast("string")).alias("query"),
                         F.struct(F.lit("").alias("answer"), found.alias("results")).alias("response"))
    yield "first_seen", dedupe.first_seen(k, "k", F.col("id"))
    yield "lookup", joins.lookup(k, table, "k", "key", "id")
    yield "keep_first by key", order.keep_first(k.withColumn("k", F.col("k") % 50), "id", 1000, by=("k",))
    yield "keep_last 2", runlogs.keep_last(metrics, 2)
    yield "with_next", order.with_next(dialog(spark, rows, skewed), "conv_id", "turn", {"nxt": "text"})
    yield "split_exact", splits.split_exact(k, "id", rows // 10, rows // 20)
    yield "length profile", profiling.token_stats(questions.withColumn("k", F.col("question")).withColumn("k", F.hash("k") % 50),
                                                  "question", "id", ("k",), cap=None)
    yield "early stop counters", enrich.Enrichment(questions, cache, limit=rows // 20).prepare().counters()


def slowest_over_mean(spark, since: int) -> float:
    """Largest ratio of slowest task to mean task among stages that ran at least a second in total."""
    store, new_array = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array
    worst, stages = 1.0, store.stageList(None, False, False, new_array(spark._jvm.double, 0), None)
    for i in range(stages.size()):
        stage = stages.apply(i)
        if stage.stageId() <= since or stage.numCompleteTasks() < 4:
            continue
        maximum = new_array(spark._jvm.double, 1)
        maximum[0] = 1.0
        summary = store.taskSummary(stage.stageId(), stage.attemptId(), maximum)
        if summary.isDefined():
            slowest = summary.get().executorRunTime().apply(0)
            mean = stage.executorRunTime() / stage.numCompleteTasks()
            if stage.executorRunTime() > 1000:
                worst = max(worst, slowest / max(mean, 1))
    return worst


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 8_000_000
    spark = build_session("skew", "local[8]", 32)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # joins as they are at scale
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.range(1).count()
    for skewed in (False, True):
        for name, df in operators(spark, rows, skewed):
            last = spark.sparkContext._jsc.sc().dagScheduler().nextStageId()
            started = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            print(f"{'skewed' if skewed else 'even':7s} {name:22s} {took:6.1f} s  slowest task / mean {slowest_over_mean(spark, last):.1f}", flush=True)


if __name__ == "__main__":
    main()
