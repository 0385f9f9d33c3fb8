import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from qaloom.operators import profiling


def texts(spark, lengths, groups=None):
    rows = [(i, groups[i] if groups else "g", " ".join(["w"] * n)) for i, n in enumerate(lengths)]
    return spark.createDataFrame(rows, "id int, g string, text string").repartition(4)


def test_exact_statistics(spark):
    rng = random.Random(4)
    lengths = [rng.randint(0, 60) for _ in range(101)] + [7]
    row = profiling.token_stats(texts(spark, lengths), "text", "id", ("g",), cap=None).collect()[0]
    assert row.asDict() == {
        "g": "g", "n_rows": 102, "n_tokenized": 102, "is_estimate": False, "total_tokens_in_sample": sum(lengths),
        "est_total_tokens": sum(lengths), "avg": round(statistics.mean(lengths), 1), "min": min(lengths), "max": max(lengths),
        "median": statistics.median(lengths),
    }


def test_sampled_statistics_are_marked(spark):
    df = texts(spark, [5] * 90 + [3] * 10, ["big"] * 90 + ["small"] * 10)
    got = {r.g: r for r in profiling.token_stats(df, "text", "id", ("g",), cap=20).collect()}
    assert (got["big"].n_rows, got["big"].n_tokenized, got["big"].is_estimate, got["big"].est_total_tokens) == (90, 20, True, 450)
    assert (got["small"].n_tokenized, got["small"].is_estimate, got["small"].est_total_tokens) == (10, False, 30)
    whole = profiling.token_stats(df, "text", "id", cap=40).collect()[0]
    assert (whole.n_rows, whole.n_tokenized, whole.is_estimate) == (100, 40, True)


def test_empty_table_and_other_token_counts(spark):
    empty = profiling.token_stats(texts(spark, [1]).where("id < 0"), "text", "id", cap=None).collect()
    assert [r.n_tokenized for r in empty] == [0] and empty[0].est_total_tokens == 0
    df = spark.createDataFrame([(1, "ab cd")], "id int, text string")
    assert profiling.token_stats(df, "text", "id", cap=None, method="chars").collect()[0].max == 5
    assert profiling.token_stats(df, "text", "id", cap=None, tokens=F.lit(9)).collect()[0].max == 9
    with pytest.raises(ValueError):
        profiling.token_stats(df, "text", "id", cap=None, method="subword")


def test_means_are_rounded_half_to_even(spark):
    rows = profiling.token_stats(texts(spark, [12, 12, 12, 13, 12, 13, 13, 13], list("aaaabbbb")), "text", "id", ("g",), cap=None)
    assert {r.g: r.avg for r in rows.collect()} == {"a": round(12.25, 1), "b": round(12.75, 1)} == {"a": 12.2, "b": 12.8}


def test_profile_totals(spark):
    df = spark.createDataFrame([("d1", "train", "a b"), ("d1", "test", "a"), ("d2", "train", "a b c d")], "dataset string, split string, text string")
    got = {(r.dataset, r.split): (r.n_rows, r.total_tokens, r.median) for r in profiling.profile(df, "text").collect()}
    assert got == {("d1", "train"): (1, 2, 2.0), ("d1", "test"): (1, 1, 1.0), ("d1", None): (2, 3, 1.5), ("d2", "train"): (1, 4, 4.0),
                   ("d2", None): (1, 4, 4.0), (None, None): (3, 7, 2.0)}


@pytest.mark.parametrize("lengths", [[1, 2, 3, 4, 41, 81], [5, 5, 5], list(range(300))])
def test_histogram_closes_the_last_bin(spark, lengths):
    counts, edges = np.histogram(lengths, bins=40)
    rows = profiling.histogram(texts(spark, lengths), "text").orderBy("bin").collect()
    assert [r.n_rows for r in rows] == counts.tolist()
    assert [r.bin_from for r in rows] + [rows[-1].bin_to] == pytest.approx(edges.tolist())
    assert rows[0]["mean"] == pytest.approx(statistics.mean(lengths), abs=1e-6)


def test_budget_cuts_only_long_rows(spark):
    df = spark.createDataFrame([(1, "a  b\nc"), (2, "a  b\nc d")], "id int, text string")
    got = {r.id: (r.text, r.n_tokens, r.over_budget) for r in profiling.len_budget(df, "text", 3).collect()}
    assert got == {1: ("a  b\nc", 3, False), 2: ("a b c", 4, True)}
    report = profiling.len_budget_report(profiling.len_budget(df, "text", 3)).collect()[0]
    assert (report.n_rows, report.n_over, report.share_over) == (2, 1, 0.5)


def test_size_counts_each_file_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartition(3).write.parquet(path)
    bytes_on_disk = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    row = profiling.size_mb(spark, path).collect()[0]
    assert (row.n_files, row.size_mb) == (3, round(bytes_on_disk / 1e6, 2))
    plan = profiling.size_mb(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<length:bigint>" in plan and "parquet [" not in plan


def test_sizes_per_split(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).withColumn("split", F.when(F.col("id") < 10, "test").otherwise("train")).repartition(2).write.partitionBy("split").parquet(path)
    got = {r.split: r.n_files for r in profiling.size_mb(spark, path, "split").collect()}
    assert got == {"train": 2, "test": 2}


def test_several_texts_in_one_pass_and_merged(spark):
    rng = random.Random(2)
    rows = [(i, "ab"[i % 2], *(" ".join(["w"] * rng.randint(0, 30)) for _ in range(3))) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, g string, prompt string, chosen string, rejected string")
    names = ["prompt", "chosen", "rejected"]
    whole = profiling.profile_texts(df, names, "id", ("g",))
    counts = {c: profiling.token_count(F.col(c)) for c in names}
    parts = [profiling.store_lengths(profiling.length_table(df.where(w), counts, ("g",))) for w in ("id < 50", "id >= 50")]
    merged = profiling.text_stats(profiling.merge_lengths(*parts), names, ("g",))
    assert sorted(map(str, whole.collect())) == sorted(map(str, merged.collect())) and whole.count() == 6
    for r in whole.collect():
        lengths = [len(x[2 + names.index(r.text)].split()) for x in rows if x[1] == r.g]
        assert (r.n_rows, r.total_tokens_in_sample, r.est_total_tokens, r.median, r.avg) == (
            100, sum(lengths), sum(lengths), statistics.median(lengths), round(statistics.mean(lengths), 1))
    sampled = {(r.g, r.text): r for r in profiling.profile_texts(df, names, "id", ("g",), cap=40).collect()}
    assert len(sampled) == 6 and all(r.is_estimate and r.n_tokenized == 40 and r.n_rows == 100 for r in sampled.values())
    assert {(r.text, r.n_rows) for r in profiling.profile_texts(df.limit(0), names, "id").collect()} == {(n, 0) for n in names}


def test_tokenizers_plug_in(spark):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    from qaloom.functions import tokenizing

    texts = ["Hello, world!  naïve_1 -- x", "", None, "日本語 テキスト", "a " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(2)
    for file in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        path = public_tokenizers.path(file)
        got = {r.id: r.n for r in df.select("id", tokenizing.tokenizer_count("text", file, tokenizing.library_tokenizer(path), 2).alias("n")).collect()}
        if file.endswith(".json"):
            encode = lambda t: Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids  # noqa: E731, B023
        else:
            encode = sentencepiece.SentencePieceProcessor(model_file=path).encode
        assert got == {i: len(encode(t or "")) for i, t in enumerate(texts)}
    plan = df.withColumn("wide", F.lit("x")).select("id", "wide", tokenizing.tokenizer_count("text", "w", tokenizing.split_tokenizer).alias("n"))
    assert {r.id: r.n for r in plan.collect()}[0] == 7


def test_empty_histogram(spark):
    assert profiling.histogram(texts(spark, [1]).limit(0), "text").count() == 0
