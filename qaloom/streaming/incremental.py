"""Append/resume jobs as incremental queries: file source, checkpoint folder, availableNow trigger.

Each query processes what arrived since its last run and stops; the checkpoint folder is what makes a restart continue.
What a query has to remember is either a ``BucketTable`` (the response log, the questions already seen) or keyed state in
Spark's state store (run logs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom import schemas
from qaloom.functions.text import is_blank, utrim
from qaloom.operators.dedupe import last_written, packed, text_digest
from qaloom.session import scratch_dir
from qaloom.sources.files import path_exists, remove_path
from qaloom.sources.readers import latest_lines, parse_cache
from qaloom.streaming.buckets import FANOUT, FILTERS, BucketTable, bloom_rows, bucket_of, filter_blocks, maybe_seen

LOG_LINES = T.StructType([T.StructField("value", T.StringType())])
RESPONSES = T.StructType([*schemas.CACHE.fields, T.StructField("written", T.DecimalType(38, 0))])
SEEN = T.StructType([T.StructField("key", T.BinaryType())])


def _run(stream: DataFrame, handle, checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def response_table(spark: SparkSession, out: str, fanout: int = FANOUT) -> BucketTable:
    return BucketTable(spark, out, {"responses": RESPONSES}, fanout=fanout)


def upsert_responses(table: BucketTable, lines: DataFrame, batch_id: int) -> None:
    """One micro-batch of log lines (value, file, block, line): its last response per query becomes a run.

    Writes are ordered by batch, then file name, then position. A batch that the table holds already is left alone.
    """
    if table.done(batch_id):
        return
    latest = latest_lines(parse_cache(lines), lines)
    rows = latest.select("query", "response", packed((F.lit(batch_id), 62), ("number", 64)).alias("written"))
    name = f"b{batch_id}"
    table.write("responses", name, rows.withColumn("bucket", bucket_of(F.col("query"))))
    table.commit(batch_id, name)
    while table.compact({"responses": lambda df, _: last_written(df, "query", F.col("written")).select(*RESPONSES.names, "bucket")}):
        pass


def stream_cache_upsert(spark: SparkSession, src: str, out: str, checkpoint: str, fanout: int = FANOUT) -> DataFrame:
    """New response-log files are folded into the latest response per query (last write wins); returns that table."""
    log = spark.readStream.schema(LOG_LINES).text(src)
    lines = log.select("value", F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("block"))

    def upsert(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("line", F.monotonically_increasing_id())
        upsert_responses(response_table(batch.sparkSession, out, fanout), numbered, batch_id)

    _run(lines, upsert, checkpoint)
    return latest_cache(spark, out)


def latest_cache(spark: SparkSession, out: str) -> DataFrame:
    """Latest response per query over all live runs."""
    live = response_table(spark, out).read("responses")
    return last_written(live, "query", F.col("written")).select("query", "response")


def seen_table(spark: SparkSession, out: str, fanout: int = FANOUT) -> BucketTable:
    return BucketTable(spark, f"{out.rstrip('/')}_seen", {"keys": SEEN, "filters": FILTERS}, fanout=fanout)


def _fold_filters(table: BucketTable, keys: DataFrame, runs: list[dict]) -> DataFrame:
    return bloom_rows(keys, filter_blocks(sum(r["rows"] for r in runs), table.buckets))


def enrich_arrivals(table: BucketTable, batch: DataFrame, batch_id: int, responses: DataFrame, out: str, id_col: str) -> None:
    """One micro-batch: its questions that were never seen before, each once, with their response.

    ``responses`` has a ``key`` (digest) and a response. What was seen is a set of digests in buckets with a Bloom filter
    per run and bucket. New digests are probed first; only those the filters may hold are looked up, and only their
    buckets are read. Texts are shuffled once, to the digests that are new.
    """
    if table.done(batch_id):
        return
    spark, name = batch.sparkSession, f"b{batch_id}"
    fresh = batch.withColumn("question", utrim(F.col("question"))).where(~is_blank(F.col("question")))
    narrow = fresh.select(text_digest("question").alias("key"), F.col(id_col).alias("_id"))
    arrived_path = scratch_dir(spark, "arrived")
    firsts = narrow.groupBy("key").agg(F.min("_id").alias("_id")).withColumn("bucket", bucket_of(F.col("key"), table.buckets))
    firsts.write.parquet(arrived_path)
    arrived = spark.read.schema(firsts.schema).parquet(arrived_path)
    hits = maybe_seen(arrived.select("key", "bucket"), table.read("filters"), table.manifest()["runs"], table.buckets)
    touched = sorted(r.bucket for r in hits.select("bucket").distinct().collect())  # at most the number of buckets
    known = table.read("keys", only=touched).select("key")
    new = table.write("keys", name, arrived.join(known, "key", "left_anti").select("key", "bucket"))
    n_new = new.count()
    table.write("filters", name, bloom_rows(new, filter_blocks(n_new, table.buckets)))
    rows = arrived.join(new.select("key"), "key", "left_semi").join(responses, "key", "left").select("_id", "key", "response")
    joined = fresh.withColumn("_key", text_digest("question")).join(rows, (F.col("_key") == F.col("key")) & (F.col(id_col) == F.col("_id")))
    joined.select(*batch.columns, "response").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    table.commit(batch_id, name, n_new)
    remove_path(spark, arrived_path)
    while table.compact({"keys": lambda df, _: df.select("key", "bucket"), "filters": lambda _, runs: _fold_filters(
            table, table._read("keys", [r["name"] for r in runs]), runs)}):
        pass


def stream_dedupe_enrich(spark: SparkSession, src: str, schema: T.StructType, cache: DataFrame, out: str,
                         checkpoint: str, id_col: str = "id", fanout: int = FANOUT) -> DataFrame:
    """Every distinct question is joined with the cache once, in the run in which it first arrives; within a micro-batch
    the smallest id wins. ``cache`` has one row per query, ids are unique."""
    arrivals = spark.readStream.schema(schema).parquet(src)
    responses = cache.select(text_digest("query").alias("key"), "response")

    def enrich_new(batch: DataFrame, batch_id: int) -> None:
        enrich_arrivals(seen_table(batch.sparkSession, out, fanout), batch, batch_id, responses, out, id_col)

    _run(arrivals, enrich_new, checkpoint)
    if not path_exists(spark, out):
        return spark.createDataFrame([], T.StructType([*schema.fields, schemas.CACHE["response"]]))
    return spark.read.parquet(out).drop("batch")


def stream_dedupe_events(arrivals: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Streaming dedupe with bounded state: copies further apart than ``delay`` may both pass."""
    return arrivals.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def run_series(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``stage, step, metric, session, value``: the keyed state as of the last finished micro-batch."""
    state = spark.read.format("statestore").load(checkpoint)
    last = F.col("value")[state.schema["value"].dataType.names[0]]  # the only aggregate
    return state.select("key.stage", "key.step", "key.metric", last["session"].alias("session"), last["value"].alias("value"))


def stream_runlog(spark: SparkSession, src: str, schema: T.StructType, out: str, checkpoint: str,
                  metric: str = "eval_loss") -> DataFrame:
    """Best and latest step per stage, kept current as metric rows arrive; also written to ``out``.

    A run may start again and log a step once more; the last session counts, and of equal sessions the later time stamp
    (where rows have ``ts``), then the larger value. The state store holds one value per stage, step and metric, in as many
    partitions as the session shuffles to, and is updated in place; a stage with most of the rows is spread over its steps.
    The report is read from that state, so it does not grow with the number of micro-batches.
    """
    arrivals = spark.readStream.schema(schema).parquet(src)
    stamp = F.col("ts").cast("timestamp") if "ts" in schema.names else F.lit(None).cast("timestamp")
    last = F.max(F.struct(F.col("session").cast("bigint").alias("session"), stamp.alias("ts"), "value")).alias("last")
    state = arrivals.withColumn("step", F.col("step").cast("bigint")).groupBy("stage", "step", "metric").agg(last)
    query = state.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    best = F.min(F.when(F.col("metric") == metric, F.struct("value", "step"))).alias("best")
    folded = run_series(spark, checkpoint).groupBy("stage").agg(best, F.max("step").alias("latest_step"))
    report = folded.select("stage", F.col("best.step").alias("best_step"), F.col("best.value").alias(f"best_{metric}"), "latest_step")
    report.write.mode("overwrite").parquet(out)
    return spark.read.schema(report.schema).parquet(out)
