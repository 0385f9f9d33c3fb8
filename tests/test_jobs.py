import json

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.operators import prefs
from qaloom.operators.batches import map_batches, map_text, map_texts
from qaloom.operators.dialogs import pairs_from_dialog
from qaloom.operators.joins import zip_by_id
from qaloom.operators.splits import split_counts, split_exact
from qaloom.plans import jobs


def response(query, content="body"):
    return json.dumps({"query": query, "response": {"answer": "", "results": [{"title": "t", "url": "u", "content": content}]}})


def test_questions_file_to_tool_rows(spark, tmp_path):
    grid = spark.createDataFrame([("a",), ("b",), ("a",), ("c",)], "question string")
    questions = jobs.build_questions(grid, str(tmp_path / "questions"), limit=10)
    extra = tmp_path / "questions" / "part-extra.json"
    extra.write_text('{"question": "a"}\n{"question": " "}\n')
    (tmp_path / "cache.jsonl").write_text("\n".join([response("a"), response("b", " "), response("a", "new")]))
    counters = jobs.build_search_dataset(spark, str(tmp_path / "cache.jsonl"), str(tmp_path / "out"), questions_path=questions, limit=5)
    assert counters.collect()[0].asDict() == {"kept": 1, "cache_hits": 2, "api_calls": 1, "skipped_empty": 2, "skipped_dupe": 1}
    assert [r.value for r in spark.read.text(str(tmp_path / "out_to_search")).collect()] == ['{"question":"c"}']
    row = spark.read.parquet(str(tmp_path / "out")).collect()[0]
    assert (row.question, row.answer, "id" in row.asDict()) == ("a", "new", False)


def test_question_table_mode_needs_answers(spark, tmp_path):
    (tmp_path / "cache.jsonl").write_text(response("a") + "\n" + response("b"))
    questions = spark.createDataFrame([(1, "a", "given"), (2, "b", "")], "id int, question string, answer string")
    counters = jobs.build_search_dataset(spark, str(tmp_path / "cache.jsonl"), str(tmp_path / "out"), questions=questions)
    assert counters.collect()[0].kept == 1
    assert [r.answer for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["given"]


def test_preference_job(spark, tmp_path):
    rows = [("p", "same", "same", [1.0], [1.0]), ("p", "one", "zzz", [1.0], [0.1])]
    pairs = spark.createDataFrame(rows, "prompt string, chosen string, rejected string, chosen_vec array<float>, rejected_vec array<float>")
    counts = {r.outcome: r.n_rows for r in jobs.build_preference_dataset(pairs, str(tmp_path / "dpo")).collect()}
    assert counts == {"kept": 1, "too_similar (score>=0.85)": 1, "total": 2}
    assert [r.rejected for r in spark.read.parquet(str(tmp_path / "dpo" / "raw")).collect()] == ["zzz"]
    assert spark.read.json(str(tmp_path / "dpo" / "audit_json")).count() == 2


def test_generated_pairs_are_stored_once(spark, tmp_path):
    qa = spark.createDataFrame([(i, f"q{i}", "long answer") for i in range(20)], "id int, question string, answer string")
    echo = lambda prompts: [f"  {p.split(chr(10))[1]} \n" for p in prompts]
    pairs = jobs.generate_pairs(qa, str(tmp_path), "v1", echo)
    assert {(r.prompt, r.chosen, r.rejected) for r in pairs.collect()} == {(f"q{i}", "long answer", f"q{i}<|im_end|>") for i in range(20)}
    again = jobs.generate_pairs(qa, str(tmp_path), "v1", lambda prompts: 1 / 0)
    assert again.count() == 20
    scored = prefs.embed_sides(again, lambda texts: [[float(len(t)), 0.0] for t in texts])
    assert {round(r.cosine, 9) for r in prefs.cosine(scored).collect()} == {1.0}


def test_a_batch_function_must_answer_every_row(spark):
    with pytest.raises(Exception, match="returned 0 values"):
        prefs.embed_sides(spark.createDataFrame([("a", "b")], "chosen string, rejected string"), lambda texts: []).collect()


def test_only_texts_go_to_the_model_and_large_ones_fit(spark):
    texts = spark.range(20).select("id", F.repeat(F.lit("abcde"), 1 << 20).alias("text"), F.lit("other").alias("wide"))
    got = map_text(texts, "text", "n", lambda part: [float(len(t)) for t in part], 3, T.DoubleType())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInPandas" not in plan
    call = plan.split("ArrowEvalPython [")[1].split("]")[0]
    assert "other" not in call and "id#" not in call
    assert [r.n for r in got.select("n").distinct().collect()] == [5.0 * (1 << 20)]
    both = map_texts(texts, {"a": "text", "b": "wide"}, lambda part: [float(len(t)) for t in part], 16, T.DoubleType())
    assert both._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") == 1
    with pytest.raises(ValueError):
        map_text(texts, "text", "n", len, 0, T.DoubleType())


def test_unsplit_tables_are_formatted_and_profiled(spark, tmp_path):
    qa = spark.createDataFrame([(i, f"q {i}", "an answer") for i in range(12)], "id int, question string, answer string")
    qa.write.parquet(str(tmp_path / "raw"))
    row = jobs.profile_datasets(spark, {"qa_data": str(tmp_path / "raw")}, "id", cap=5).collect()[0]
    assert (row.split, row.text, row.n_rows, row.n_tokenized, row.is_estimate) == (None, "text", 12, 5, True)
    assert row["columns"] == ["id", "question", "answer"] and row.n_files >= 1


def test_curve_reports(spark, tmp_path):
    rows = [("s", 1, 10, "loss", 2.0), ("s", 1, 10, "eval_loss", 1.5), ("s", 1, 20, "eval_loss", 1.2)]
    jobs.write_curve_reports(spark.createDataFrame(rows, "stage string, session long, step long, metric string, value double"), str(tmp_path))
    best = spark.read.option("header", True).csv(str(tmp_path / "eval_results")).collect()[0]
    assert best.asDict() == {"model_version": "s", "metric_name": "eval_loss_best", "value": "1.2"}
    assert spark.read.option("header", True).csv(str(tmp_path / "loss_curves")).count() == 2


def test_batches_never_exceed_their_size(spark):
    got = map_batches(spark.range(50).repartition(3), lambda f: f.assign(n=len(f)), 4, "id long, n long")
    assert got.count() == 50 and got.agg(F.max("n")).first()[0] <= 4


def test_batches_decode_only_their_own_texts(spark):
    rows, chars = 4000, 4000
    df = spark.range(0, rows, 1, 1).withColumn("text", F.concat(F.lpad(F.col("id").cast("string"), chars, "a"), F.lit("\U0001F600")))

    def peak(frame):
        import tracemalloc

        if not tracemalloc.is_tracing():
            tracemalloc.start()  # in the first Arrow batch; the second is seen whole
        found = frame.assign(same=[len(t) == chars + 1 for t in frame["text"]], peak=tracemalloc.get_traced_memory()[1])
        if (frame["id"] == rows - 1).any():
            tracemalloc.stop()
        return found[["same", "peak"]]

    got = map_batches(df, peak, 16, "same boolean, peak long").agg(F.count_if("same").alias("n"), F.max("peak").alias("peak")).first()
    assert got.n == rows
    # an Arrow batch of this session has 2,000 rows: 8 MB as it came, 8 MB as UTF-8, 32 MB as text of four bytes a character
    assert 8e6 < got.peak < 24e6


def test_batches_are_the_frames_that_spark_makes(spark):
    rows = [(i, None if i % 3 == 0 else f"é{i}\U0001F600", "", i / 2, i % 2 == 0, [f"x{i}", None], None, b"\xff") for i in range(40)]
    types = "id long, s string, `e m` string, x double, flag boolean, list array<string>, none string, raw binary"
    df = spark.createDataFrame(rows, types).repartition(1).sortWithinPartitions("id")

    def shown(frame):
        return pd.DataFrame({"s": [repr((list(frame.columns), [str(d) for d in frame.dtypes], list(frame.index), frame.values.tolist()))]})

    def cut(frames):
        for frame in frames:
            for start in range(0, len(frame), 16):
                yield shown(frame.iloc[start:start + 16])

    got = [r.s for r in map_batches(df, shown, 16, "s string").collect()]
    assert got == [r.s for r in df.mapInPandas(cut, "s string").collect()] and len(got) == 3
    assert map_batches(df.select("id"), lambda f: f, 16, "id long").count() == 40


def test_pairs_need_an_assistant_turn_right_after(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "u1"), (1, 2, "user", "u2"), (1, 3, "assistant", "a2"), (2, 0, "user", "u3")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in pairs_from_dialog(df).collect()] == [("1-2", 1, 2, "u2", "a2")]


def test_long_conversations_keep_ids_and_split_sizes(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"{c}.{t}") for c, n in ((1, 204), (2, 4)) for t in range(n)]
    pairs = pairs_from_dialog(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert (pairs.count(), pairs.select("qa_id").distinct().count()) == (104, 104)
    assert zip_by_id("qa_id", pairs.select("qa_id", "question"), pairs.select("qa_id", "answer")).count() == 104
    sizes = {r.split: r.n_rows for r in split_counts(split_exact(pairs, "qa_id", 20, 5)).collect()}
    assert sizes == {"train": 84, "validation": 5, "test": 15}
