import json

from pyspark.sql import functions as F

from qaloom import schemas
from qaloom.operators.runlogs import best_checkpoint
from qaloom.operators.dedupe import text_digest
from qaloom.sources import readers
from qaloom.sources.readers import read_cache
from qaloom.streaming import buckets, incremental


def put(folder, name, *entries):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [e if isinstance(e, str) else json.dumps({"query": e[0], "response": {"answer": e[1], "results": []}}) for e in entries]
    (folder / name).write_text("\n".join(lines) + "\n")


def answers(df):
    return {r.query: r.response.answer for r in df.collect()}


def test_cache_upsert_continues_where_it_stopped(spark, tmp_path):
    src, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    put(src, "1.jsonl", ("a", "1"), ("b", "1"), "{broken", ("a", "2"))
    assert answers(incremental.stream_cache_upsert(spark, str(src), out, checkpoint)) == {"a": "2", "b": "1"}
    assert answers(incremental.stream_cache_upsert(spark, str(src), out, checkpoint)) == {"a": "2", "b": "1"}
    put(src, "2.jsonl", ("b", "3"), ("c", "1"))
    got = answers(incremental.stream_cache_upsert(spark, str(src), out, checkpoint))
    assert got == {"a": "2", "b": "3", "c": "1"} == answers(read_cache(spark, str(src)))


def test_upsert_with_repeated_batches_and_compaction(spark, tmp_path):
    """Many micro-batches, each written twice as after a failure, with runs folded in between."""
    src, out = tmp_path / "in", str(tmp_path / "out")
    table, want = incremental.response_table(spark, out, fanout=2), {}
    for batch in range(7):
        entries = [(f"q{i}", f"{batch}-{i}") for i in range(batch, batch + 3)] + [("hot", str(batch))]
        put(src, f"{batch}.jsonl", ("hot", "early"), *entries, "{broken")
        want |= dict(entries)
        lines = readers.log_lines(spark, str(src / f"{batch}.jsonl"))
        for _ in range(2):
            incremental.upsert_responses(table, lines, batch)
        # a batch that wrote its run but never its manifest
        table.write("responses", "lost", table.read("responses").withColumn("query", F.lit("lost")).drop("run"))
        assert answers(incremental.latest_cache(spark, out)) == want
    state = table.manifest()
    assert state["last_batch"] == 6 and len(state["runs"]) <= 3 and max(r["tier"] for r in state["runs"]) == 2
    assert table.read("responses").groupBy("query").count().where("count > 3").count() == 0
    folders = [p.name for p in (tmp_path / "out" / "responses").iterdir() if p.name != "run=lost"]
    assert len(folders) <= 2 * len(state["runs"]) + 1 and len(table.versions()) == 2


def test_a_question_that_comes_back_two_batches_later(spark, tmp_path):
    out = str(tmp_path / "out")
    cache = spark.createDataFrame([("a", ("x", [])), ("c", ("y", []))], schemas.CACHE)
    responses = cache.select(text_digest("query").alias("key"), "response")
    schema = "id long, question string, answer string"
    table = incremental.seen_table(spark, out, fanout=2)
    batches = [[(2, " a", ""), (1, "a", ""), (3, "b", "")], [(4, "c", ""), (5, " ", "")], [(6, "b ", ""), (7, "d", ""), (8, "a", "")], [],
               [(9, "d", ""), (10, "c", ""), (11, "e", "")]]
    for i, rows in enumerate(batches):
        for _ in range(2):
            incremental.enrich_arrivals(table, spark.createDataFrame(rows, schema), i, responses, out, "id")
    got = sorted((r.id, r.question, r.response is not None) for r in spark.read.parquet(out).collect())
    assert got == [(1, "a", True), (3, "b", False), (4, "c", True), (7, "d", False), (11, "e", False)]
    assert len(table.manifest()["runs"]) <= 3 and table.read("keys").count() == 5


def test_only_touched_buckets_are_looked_up(spark, tmp_path):
    table = incremental.seen_table(spark, str(tmp_path / "t"))
    keys = spark.range(3000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("key"))
    keys = keys.withColumn("bucket", buckets.bucket_of(F.col("key")))
    table.write("keys", "b0", keys)
    table.write("filters", "b0", buckets.bloom_rows(keys, buckets.filter_blocks(3000, table.buckets)))
    table.commit(0, "b0", 3000)
    runs = table.manifest()["runs"]
    assert buckets.maybe_seen(keys, table.read("filters"), runs, table.buckets).count() == 3000
    others = spark.range(3000, 6000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("key")).withColumn("bucket", buckets.bucket_of(F.col("key")))
    assert buckets.maybe_seen(others, table.read("filters"), runs, table.buckets).count() < 60
    plan = table.read("keys", only=[3, 5])._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in plan.split("PartitionFilters")[1].split("]")[0]
    assert {r.bucket for r in table.read("keys", only=[3, 5]).select("bucket").distinct().collect()} == {3, 5}


def test_questions_are_enriched_once(spark, tmp_path):
    src, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "id long, question string, answer string"
    cache = spark.createDataFrame([("a", ("x", []))], schemas.CACHE)
    first = spark.createDataFrame([(2, " a", ""), (1, "a", ""), (3, "b", ""), (4, " ", "")], schema)
    first.write.mode("append").parquet(src)
    run = lambda: incremental.stream_dedupe_enrich(spark, src, first.schema, cache, out, checkpoint)
    assert sorted((r.id, r.question, r.response is not None) for r in run().collect()) == [(1, "a", True), (3, "b", False)]
    spark.createDataFrame([(5, "b", ""), (6, "c", "")], schema).write.mode("append").parquet(src)
    assert sorted((r.id, r.question) for r in run().collect()) == [(1, "a"), (3, "b"), (6, "c")]


def test_run_state_equals_the_batch_result(spark, tmp_path):
    src, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "stage string, session long, step long, metric string, value double"
    parts = [[("s", 1, 10, "eval_loss", 0.5), ("s", 1, 20, "eval_loss", 0.4), ("t", 1, 5, "loss", 1.0)],
             [("s", 1, 30, "eval_loss", 0.4), ("s", 1, 40, "loss", 9.0), ("t", 1, 6, "eval_loss", 2.0)],
             [("s", 2, 20, "eval_loss", 0.9)]]  # a restart supersedes a best step of an earlier batch
    for part in parts:
        df = spark.createDataFrame(part, schema)
        df.write.mode("append").parquet(src)
        got = incremental.stream_runlog(spark, src, df.schema, out, checkpoint)
        batch = best_checkpoint(spark.read.parquet(src)).select("stage", "best_step", "best_eval_loss", "latest_step")
        assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect()))
    # nothing new: the state is only read again
    again = incremental.stream_runlog(spark, src, df.schema, out, checkpoint)
    assert sorted(map(str, again.collect())) == sorted(map(str, batch.collect()))
    assert incremental.run_series(spark, checkpoint).count() == 6  # one value per stage, step and metric


def test_watermarked_dedupe(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:00:05"), ("b", "2024-01-01 00:00:06")], "q string, ts string")
    rows.select("q", F.to_timestamp("ts").alias("ts")).write.parquet(src)
    stream = incremental.stream_dedupe_events(spark.readStream.schema("q string, ts timestamp").parquet(src), "q", "ts", "1 minute")
    query = (stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(r.q for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
