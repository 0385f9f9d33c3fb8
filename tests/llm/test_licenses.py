"""License scan against all windows of the grid, one by one."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from qaloom.llm import licenses
from qaloom.llm.license_texts import TEMPLATES

SCHEMA = "doc_id bigint, text string, license string, words string, s int, part int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "w", "x", 1, 2) for i, t in texts], SCHEMA)


def brute(texts, templates: list[tuple[str, str]]) -> dict:
    """(id, license) -> (containment, first word), by every window."""
    shingled = [(name, set(licenses.template_shingles(text))) for name, text in templates]
    sizes = licenses.size_classes(len(s) for _, s in shingled)
    best: dict = {}
    for doc_id, text in texts:
        words = licenses.template_words(text or "")
        grams = [" ".join(words[i : i + 5]) for i in range(len(words) - 4)]
        for name, want in shingled:
            window, stride, _ = sizes[len(want)]
            if want.isdisjoint(grams):
                continue
            for at in range(0, max(len(grams) - window + stride, 1), stride):
                share = len(want & set(grams[at : at + window])) / len(want)
                if share >= 0.8 and (share, -at) > best.get((doc_id, name), (0, 0)):
                    best[doc_id, name] = (share, -at)
    return {k: (s, -at) for k, (s, at) in best.items()}


def found(spark, texts, templates=None) -> dict:
    rows = licenses.scan(frame(spark, texts), templates).collect()
    assert len({(r.doc_id, r.license) for r in rows}) == len(rows)
    return {(r.doc_id, r.license): (r.containment, r.first_word) for r in rows}


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(["the", "license", "software", "of", "this", "ka", "lo", "mi"]) for _ in range(n))


def corpus() -> list[tuple]:
    rng = random.Random(11)
    texts = []
    for text in TEMPLATES.values():
        texts.append(prose(rng, rng.randint(0, 90)) + "\n# " + text.upper() + "\n" + prose(rng, rng.randint(0, 90)))
        words = text.split()
        if len(words) > 20:
            for every in (9, 24, 60):  # words put into the notice, every so many
                texts.append(" ".join(w + (" inserted" if i % every == every - 1 else "") for i, w in enumerate(words)))
            texts.append(" ".join(words[len(words) // 10 :]))
            texts.append(" ".join(words[len(words) // 3 :]))
    texts += [None, "", " \n", "released under the", "Released under the MIT License. " * 3]
    return [*enumerate(texts), (None, texts[0]), (0, texts[0])]


def test_every_window_of_notices_whole_cut_and_with_words_inserted(spark):
    texts = corpus()
    want, got = brute(texts, list(TEMPLATES.items())), found(spark, texts)
    assert set(got) <= set(want)
    assert len(got) >= 0.99 * len(want) > 60
    exact = [k for k in got if want[k] == got[k]]
    assert len(exact) >= 0.97 * len(want)  # else another window than the best one was found
    for name in TEMPLATES:
        assert any(k[1] == name for k in got), name


def test_table_of_templates_with_shared_names_and_repeats(spark):
    rng = random.Random(3)
    rows = [(f"l{i % 40}", " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(5, 120)))) for i in range(300)]
    templates = spark.createDataFrame([*rows, *rows[:20]], "license string, text string").withColumn("n", F.lit(0))
    texts = [(i, "start of it " + t + " end") for i, (_, t) in enumerate(rows)]
    got = found(spark, texts, templates)
    assert set(brute(texts, rows)) == set(got)
    assert {(i, name) for i, (name, _) in enumerate(rows)} <= set(got)


def test_templates_that_cannot_be_found_are_refused(spark):
    for bad in [("a", "four words are few"), ("a", None), (None, "five words are quite enough")]:
        with pytest.raises(ValueError, match="five|name"):
            licenses.scan(frame(spark, [(1, "x")]), spark.createDataFrame([bad], "license string, text string"))
    none = spark.createDataFrame([], "license string, text string")
    assert licenses.scan(frame(spark, corpus()), none).count() == 0


def test_long_text_with_a_notice_at_the_end_and_one_of_notices_only(spark):
    rng = random.Random(4)
    texts = [(1, prose(rng, 200_000) + " " + TEMPLATES["isc"]), (2, (TEMPLATES["mit"] + "\n") * 20_000), (3, (TEMPLATES["isc"] + "\n") * 300)]
    got = found(spark, texts)
    assert {(1, "isc"), (2, "mit"), (3, "isc")} <= set(got)
    assert got[2, "mit"] == (1.0, 0) and got[1, "isc"][1] > 199_000


def test_plan_has_no_python_and_does_not_grow_with_the_templates(spark):
    docs = frame(spark, [(1, "x")])
    plans = []
    for n in (5, 500):
        templates = spark.range(n).select(F.col("id").cast("string").alias("license"), F.concat(F.lit("some words before number "), "id").alias("text"))
        plans.append(licenses.scan(docs, templates)._jdf.queryExecution().executedPlan().toString())
    assert all("Python" not in p and "Arrow" not in p for p in plans)
    assert len(plans[1]) < 1.2 * len(plans[0])
