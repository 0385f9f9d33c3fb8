import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from qaloom.operators import prefs


def chrf_of(hyp, ref, order=6, beta=2.0):
    """F-score from the definition: mean precision and recall over the orders both sides have."""
    hyp, ref = "".join(hyp.split()), "".join(ref.split())
    precisions, recalls = [], []
    for n in range(1, order + 1):
        if min(len(hyp), len(ref)) < n:
            break
        h, r = (Counter(t[i:i + n] for i in range(len(t) - n + 1)) for t in (hyp, ref))
        common = sum((h & r).values())
        precisions.append(common / sum(h.values()))
        recalls.append(common / sum(r.values()))
    if not precisions or sum(precisions) + sum(recalls) == 0:
        return 0.0
    p, r = sum(precisions) / len(precisions), sum(recalls) / len(recalls)
    return (1 + beta**2) * p * r / (beta**2 * p + r)


def scores(spark, pairs, **kw):
    df = spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(pairs)], "i int, rejected string, chosen string").repartition(3)
    return [r.chrf for r in prefs.chrf(df, **kw).orderBy("i").collect()]


def test_known_chrf_cases(spark):
    pairs = [("abcdefgh", "abcdefgh"), ("abc", "xyz"), ("ab", "ab"), ("a b\nc", "abc"), ("", ""), ("", "a"), ("a", ""), ("A", "a"),
             ("Уулын хэл", "Уулын"), (None, None)]
    got = scores(spark, pairs)
    assert got[:8] == [1.0, 0.0, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0] and got[9] == 0.0
    assert got[8] == pytest.approx(chrf_of(*pairs[8]), abs=1e-12)


def test_chrf_equals_the_definition_on_random_texts(spark):
    rng = random.Random(5)
    alphabets = ["ab", "abc de", "абвгд ", "".join(chr(0x4E00 + i) for i in range(3000)) + "😀"]
    pairs = []
    for i in range(120):
        letters = alphabets[i % 4]
        ref = "".join(rng.choices(letters, k=rng.randint(0, 80)))
        hyp = ref[rng.randint(0, 20):] + "".join(rng.choices(letters, k=rng.randint(0, 30)))
        pairs.append((hyp, ref))
    pairs.append(("ab " * 30_000, "ba " * 30_000))  # one text far above the chunk size
    assert scores(spark, pairs) == pytest.approx([chrf_of(h, r) for h, r in pairs], abs=1e-12)
    assert scores(spark, pairs[:20], order=3, beta=1.0) == pytest.approx([chrf_of(h, r, 3, 1.0) for h, r in pairs[:20]], abs=1e-12)


def test_weights_recall_more_than_precision(spark):
    forward, backward = scores(spark, [("abcdef", "abc"), ("abc", "abcdef")])
    assert forward > backward


def test_threshold_is_dropped(spark):
    df = spark.createDataFrame([(0.8499999,), (0.85,), (0.8500001,)], "score double").transform(prefs.flag_similar)
    rows = [(r.kept, r.drop_reason) for r in df.orderBy("score").collect()]
    assert rows == [(True, None), (False, "too_similar (score>=0.85)"), (False, "too_similar (score>=0.85)")]


def test_audit_counts_and_kept_rows(spark):
    rows = [("p1", "same text", "same text", [1.0, 0.0], [1.0, 0.0]), ("p2", "good answer", "zzz", [1.0, 0.0], [0.0, 1.0])]
    df = spark.createDataFrame(rows, "prompt string, chosen string, rejected string, chosen_vec array<float>, rejected_vec array<float>")
    audit = prefs.pref_audit(df)
    got = {r.prompt: r for r in audit.collect()}
    assert got["p1"].score == pytest.approx(1.0) and not got["p1"].kept
    assert got["p2"].score == pytest.approx(0.3 * chrf_of("zzz", "good answer")) and got["p2"].kept
    assert [r.prompt for r in prefs.kept_pairs(audit).collect()] == ["p2"]
    assert {r.outcome: r.n_rows for r in prefs.drop_counts(audit).collect()} == {"kept": 1, "too_similar (score>=0.85)": 1, "total": 2}


def test_vectors(spark):
    from qaloom.functions.vectors import dot, l2_normalise

    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    got = [r.u for r in df.select(l2_normalise(F.col("v")).alias("u")).collect()]
    assert got == [[0.6, 0.8], None]
    assert df.select(dot(F.col("v"), F.col("v")).alias("d")).collect()[0].d == 25.0
    pairs = spark.createDataFrame([(1, 0, 1), (2, 1, 9)], "id int, a int, b int")
    vectors = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id int, embedding array<float>")
    joined = prefs.join_vectors(pairs, vectors, "id", {"x": "a", "y": "b"})
    assert {r.id: (r.x, r.y) for r in joined.collect()} == {1: ([1.0], [2.0]), 2: ([2.0], None)}


def test_length_bias(spark):
    df = spark.createDataFrame([("a", "b c", ""), ("a a", "b", "x y z")], "prompt string, chosen string, rejected string")
    row = prefs.length_bias(df).collect()[0]
    assert (row.n_rows, row.prompt_avg, row.chosen_max, row.rejected_min, row.rejected_max) == (2, 1.5, 2, 0, 3)


def test_vectors_of_pairs_that_mostly_point_at_one(spark, monkeypatch):
    monkeypatch.setattr(prefs, "MIN_HOT_ROWS", 50)
    pairs = spark.range(900).select("id", F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 40).cast("long").alias("a"),
                                    F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 45).cast("long").alias("b"))
    vectors = spark.range(40).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("double")).alias("embedding"))
    rows = prefs.join_vectors(pairs, vectors, "id", {"x": "a", "y": "b"}).collect()
    assert len(rows) == len({r.id for r in rows}) == 900
    for r in rows:
        assert r.x == [float(r.a)] and r.y == (None if r.b is None or r.b >= 40 else [float(r.b)])
