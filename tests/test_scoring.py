import math
import random
import string
from collections import Counter

import pytest

from qaloom.operators import scoring


def frame(spark, pairs):
    return spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(pairs)], "i int, prediction string, reference string").repartition(3)


def column(df, name):
    return [r[name] for r in df.orderBy("i").collect()]


def bag(text, mode):
    chunks = (text or "").lower().split()
    if mode == "char_loose":
        chunks = [c for c in chunks if not (len(c) == 1 and c in string.punctuation)]
        return Counter("".join(chunks))
    return Counter(c for c in "".join(chunks) if c not in string.punctuation)


def f1_of(p, r, mode):
    a, b = bag(p, mode), bag(r, mode)
    if not a or not b:
        return float(not a and not b)
    same = sum((a & b).values())
    return 2 * same / (sum(a.values()) + sum(b.values()))


def test_f1_of_empty_sides(spark):
    pairs = [("", ""), ("", "x"), ("x", ""), ("!", "!"), (None, ""), ("!!!", "?")]
    assert column(scoring.qa_f1(frame(spark, pairs), "char_loose"), "f1") == [1.0, 0.0, 0.0, 1.0, 1.0, 0.0]
    assert column(scoring.qa_f1(frame(spark, pairs), "char_strict"), "f1") == [1.0, 0.0, 0.0, 1.0, 1.0, 1.0]


def test_hand_computed_f1(spark):
    pairs = [("a, b", "ab"), ("aab", "abb"), ("xyz", "abc")]
    assert column(scoring.qa_f1(frame(spark, pairs), "char_loose"), "f1") == pytest.approx([0.8, 2 / 3, 0.0])
    assert column(scoring.qa_f1(frame(spark, pairs), "char_strict"), "f1") == pytest.approx([1.0, 2 / 3, 0.0])


@pytest.mark.parametrize("mode", ["char_loose", "char_strict"])
def test_f1_equals_counting_and_is_symmetric(spark, mode):
    rng = random.Random(2)
    letters = "abcАбВ,.! \n\t-😀 "
    pairs = [("".join(rng.choices(letters, k=rng.randint(0, 25))), "".join(rng.choices(letters, k=rng.randint(0, 25)))) for _ in range(150)]
    got = column(scoring.qa_f1(frame(spark, pairs), mode), "f1")
    assert got == pytest.approx([f1_of(p, r, mode) for p, r in pairs], abs=1e-12)
    assert column(scoring.qa_f1(frame(spark, [(r, p) for p, r in pairs]), mode), "f1") == pytest.approx(got, abs=1e-12)
    assert all(0.0 <= x <= 1.0 for x in got)


def test_exact_match_modes(spark):
    pairs = [(" a ", "a\n"), ("A", "a"), ("a!", "a"), (" ", "")]
    assert column(scoring.qa_em(frame(spark, pairs)), "em") == [1.0, 0.0, 0.0, 1.0]
    assert column(scoring.qa_em(frame(spark, pairs), "normalised"), "em") == [1.0, 1.0, 1.0, 1.0]
    with pytest.raises(ValueError):
        scoring.qa_em(frame(spark, pairs), "other")


def test_means_and_percentages(spark):
    row = scoring.qa_scores(frame(spark, [("a", "a"), ("b", "c"), ("ab", "a")])).collect()[0]
    assert (row.n_rows, row.exact_match_pct, row.f1_pct) == (3, 33.33, 55.56)


def test_perplexity(spark):
    rows = [("a", 1.0, 5), ("a", 3.0, 6), ("a", 99.0, -100), ("b", 1000.0, 1), ("c", 5.0, -100)]
    df = spark.createDataFrame(rows, "g string, nll double, label int")
    got = {r.g: r.perplexity for r in scoring.perplexity(df, "g").collect()}
    assert got == {"a": pytest.approx(math.exp(2)), "b": math.inf}
