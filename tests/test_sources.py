import json

import pytest
from pyspark.sql import functions as F

from qaloom.operators import runlogs
from qaloom.plans import jobs
from qaloom.sources import readers, writers


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_questions(spark, tmp_path):
    path = write(tmp_path / "q.jsonl", '{"question": "a"}', "", "  ", '{"other": 1}', '{"question": "б", "answer": "x"}', '{"question": null}')
    assert sorted(tuple(r) for r in readers.read_questions(spark, path).collect()) == [("a", ""), ("б", "x")]


@pytest.mark.parametrize("bad", ['{"question": "a"', '{"question": "a"} x'])
def test_a_corrupt_question_line_is_an_error_unless_tolerated(spark, tmp_path, bad):
    path = write(tmp_path / "q.jsonl", '{"question": "a"}', bad)
    with pytest.raises(Exception, match="corrupt question line"):
        readers.read_questions(spark, path).collect()
    assert [r.question for r in readers.read_questions(spark, path, strict=False).collect()] == ["a"]


def test_cache_keeps_the_last_write_and_skips_corrupt_lines(spark, tmp_path):
    entry = lambda q, a, **r: json.dumps({"query": q, "response": {"answer": a, **r}}, ensure_ascii=False)
    write(tmp_path / "log" / "1.jsonl", entry("q", "old"), "{broken", entry("q", "newer"), entry("only", "x", results=[{"url": None, "content": "c"}]))
    write(tmp_path / "log" / "2.jsonl", entry("q", "newest") + " garbage", entry("w", "w"), '{"query": "none", "response": null}')
    got = {r.query: r.response for r in readers.read_cache(spark, str(tmp_path / "log")).collect()}
    assert got["q"].answer == "newer" and got["w"].answer == "w" and got["none"] is None
    assert got["only"].results[0].asDict() == {"title": None, "url": None, "content": "c"}


def test_last_write_survives_many_small_file_splits(spark, tmp_path):
    lines = [json.dumps({"query": f"q{i % 7}", "response": {"answer": str(i)}}) for i in range(2000)]
    path = write(tmp_path / "log.jsonl", *lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 10
        got = {r.query: int(r.response.answer) for r in readers.read_cache(spark, path).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"q{k}": max(i for i in range(2000) if i % 7 == k) for k in range(7)}


@pytest.mark.parametrize("broadcast_files", [0, 100])
def test_last_write_over_files_read_twice(spark, tmp_path, broadcast_files):
    """Files count in the order of their names, whichever is larger or listed first, and the log is scanned twice."""
    want = {}
    for name, n in [("10 a%b.jsonl", 900), ("9.jsonl", 40), ("1.jsonl", 300), ("empty.jsonl", 0)]:
        lines = [json.dumps({"query": f"q{i % (n // 2)}", "response": {"answer": f"{name} {i}"}}) for i in range(n)]
        write(tmp_path / "log" / name, *lines)
    for name, n in [("1.jsonl", 300), ("10 a%b.jsonl", 900), ("9.jsonl", 40)]:
        want |= {f"q{i % (n // 2)}": f"{name} {i}" for i in range(n)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        latest = readers.read_cache(spark, str(tmp_path / "log"), broadcast_files)
        got = {r.query: r.response.answer for r in latest.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == want
    assert latest._jdf.queryExecution().sparkPlan().toString().count("FileScan text") == 2


LOG = [
    "2031-02-03 04:05:06,007 - INFO - Training started, run r1",
    "2031-02-03 04:06:30,500 - INFO - Step 10: loss=1.5, grad_norm=1.0, learning_rate=1e-05",
    "  a continuation line: Step 99: loss=0",
    "2031-02-03 04:06:31,250 - WARNING - Step of something else",
    "2031-02-03 04:08:00,125 - INFO - Step 20: eval_loss=1.25, rewards/chosen=-2.5",
    "2031-02-03 04:09:00,000 - INFO - Second attempt: training started",
    "2031-02-03 04:10:00,000 - INFO - Step 10: loss=0.0, epoch=nan",
]


@pytest.mark.parametrize("split_bytes", ["134217728", "150"])
def test_run_log_sessions_and_metrics(spark, tmp_path, split_bytes):
    write(tmp_path / "logs" / "run-a.log", *LOG)
    write(tmp_path / "logs" / "run-b.log", *LOG[:2])
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        rows = readers.read_runlog(spark, str(tmp_path / "logs")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    a = {(r.session, r.step, r.metric): r.value for r in rows if r.stage == "run-a"}
    assert a == {(1, 10, "loss"): 1.5, (1, 10, "grad_norm"): 1.0, (1, 10, "learning_rate"): 1e-05, (1, 20, "eval_loss"): 1.25,
                 (1, 20, "rewards/chosen"): -2.5, (2, 10, "loss"): 0.0, (2, 10, "epoch"): pytest.approx(float("nan"), nan_ok=True)}
    assert {(r.session, r.step) for r in rows if r.stage == "run-b"} == {(1, 10)}
    curves = runlogs.run_curves(readers.read_runlog(spark, str(tmp_path / "logs"))).where("stage = 'run-a'").orderBy("step").collect()
    assert [(r.step, r.loss, r.eval_loss) for r in curves] == [(10, 0.0, None), (20, None, 1.25)]


def test_metric_rows_and_reward_curves(spark, tmp_path):
    lines = spark.createDataFrame([(line,) for line in LOG], "value string")
    events = readers.parse_log_events(lines)
    assert events.count() == 6 and events.where("is_start").count() == 2
    assert runlogs.metric_rows(events).count() == 3
    write(tmp_path / "r.log", *LOG)
    rewards = runlogs.run_curves(readers.read_runlog(spark, str(tmp_path / "r.log")), runlogs.REWARD_METRICS).collect()
    assert [(r.step, r["rewards/chosen"], r["rewards/margins"]) for r in rewards] == [(20, -2.5, None)]


def test_resolution_order_and_load(spark, tmp_path):
    places = {"qa_data": {k: str(tmp_path / k) for k in ("mapped", "raw", "published")}}
    with pytest.raises(FileNotFoundError):
        readers.resolve(spark, "qa_data", places)
    base = spark.range(40).select("id", F.concat(F.lit("q"), "id").alias("question"), F.lit("a").alias("answer"))
    writers.write_table(base, places["qa_data"]["published"])
    assert readers.resolve(spark, "qa_data", places)[1] == "published"
    writers.write_table(base.where("id < 20"), places["qa_data"]["raw"])
    sizes = {"qa_data": {"test": 8, "validation": 3}}
    train, validation = jobs.load_dataset(spark, "qa_data", places, sizes, "id")
    assert (train.count(), validation.count()) == (12, 3)
    assert train.first().text.startswith("<|im_start|>user\nq")
    assert readers.resolve(spark, "qa_data", places)[1] == "mapped"
    stored = writers.recorded_version(spark, places["qa_data"]["mapped"])
    assert jobs.load_dataset(spark, "qa_data", places, sizes, "id", only_test=True).count() == 5
    assert writers.recorded_version(spark, places["qa_data"]["mapped"]) == stored
    # a changed source or other sizes give other splits
    writers.write_table(base, places["qa_data"]["raw"])
    assert [p.count() for p in jobs.load_dataset(spark, "qa_data", places, sizes, "id")] == [32, 3]
    sizes["qa_data"]["test"] = 10
    assert [p.count() for p in jobs.load_dataset(spark, "qa_data", places, sizes, "id")] == [30, 3]
    # without a source the stored splits are all there is
    only = {"qa_data": {"mapped": places["qa_data"]["mapped"]}}
    assert jobs.load_dataset(spark, "qa_data", only, sizes, "id", only_test=True).count() == 7


def test_a_table_that_does_not_fit_its_kind_is_refused(spark, tmp_path):
    path = writers.write_table(spark.createDataFrame([(1, 2)], "question int, other int"), str(tmp_path / "raw"))
    with pytest.raises(ValueError, match="question: int, not string; answer: missing"):
        readers.resolve(spark, "qa_data", {"qa_data": {"raw": path}})
    assert readers.read_columnar(spark, path).count() == 1


def test_catalog_table_as_published_copy(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("qa_copy")
    df, origin = readers.resolve(spark, "x", {"x": {"raw": str(tmp_path / "none"), "published": "qa_copy"}})
    assert (df.count(), origin) == (3, "published")


def test_snapshot_is_immutable_and_described(spark, tmp_path):
    df = spark.range(5).withColumn("v", F.lit("x"))
    manifest = writers.publish_snapshot(df, str(tmp_path), "v1").collect()[0]
    assert manifest.asDict() == {"version": "v1", "n_rows": 5, "columns": ["id", "v"]}
    with pytest.raises(FileExistsError):
        writers.publish_snapshot(df, str(tmp_path), "v1")
    assert spark.read.json(str(tmp_path / "manifest=v1")).collect()[0].n_rows == 5


def test_stage_is_reused_only_for_the_same_input(spark, tmp_path):
    path, calls = str(tmp_path / "stage"), []

    def build(n):
        calls.append(n)
        return spark.range(n)

    assert writers.stage_resume(spark, path, "a", lambda: build(3))[1] is False
    stored, reused = writers.stage_resume(spark, path, "a", lambda: build(4))
    assert (stored.count(), reused) == (3, True)
    stored, reused = writers.stage_resume(spark, path, "b", lambda: build(5))
    assert (stored.count(), reused, calls) == (5, False, [3, 5])


def test_text_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "я")], "id int, drop_reason string")
    lines = spark.read.text(writers.write_audit_json(df, str(tmp_path / "a"))).collect()
    assert {r.value for r in lines} == {'{"id":1,"drop_reason":null}', '{"id":2,"drop_reason":"я"}'}
    writers.append_jsonl(df, str(tmp_path / "j"))
    assert spark.read.text(writers.append_jsonl(df, str(tmp_path / "j"))).count() == 4
    assert {r.id for r in spark.read.option("header", True).csv(writers.write_csv(df, str(tmp_path / "c"))).collect()} == {"1", "2"}
    split = df.withColumn("split", F.when(F.col("id") == 1, "train").otherwise("test"))
    assert readers.read_splits(spark, writers.write_splits(split, str(tmp_path / "s"))).where("split = 'test'").count() == 1
    with pytest.raises(ValueError):
        readers.read_splits(spark, writers.write_table(df, str(tmp_path / "flat")))


def test_question_ids_do_not_depend_on_the_files(spark, tmp_path):
    from qaloom.operators.splits import sample_cap

    lines = [json.dumps({"question": f"q{i % 23}", "answer": "x" * (i % 2)}) for i in range(300)] + [json.dumps({"question": "hot"})] * 150
    picked = []
    for files in (1, 7):
        folder = tmp_path / str(files)
        folder.mkdir()
        for f in range(files):
            (folder / f"{f}.jsonl").write_text("\n".join(lines[f::files]) + "\n")
        numbered = readers.number_questions(readers.read_questions(spark, str(folder)))
        assert numbered.select("id").distinct().count() == 450
        picked.append(sorted((r.id, r.question, r.answer) for r in sample_cap(numbered, "id", 40).collect()))
    assert picked[0] == picked[1] and len(picked[0]) == 40
