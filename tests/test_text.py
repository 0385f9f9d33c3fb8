import json

from pyspark.sql import functions as F

from qaloom.functions import text
from qaloom.functions.jsontext import is_one_json_value, json_array, json_object, json_string


def values(spark, rows, fn):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_trim_covers_unicode_white_space_but_not_zero_width(spark):
    rows = ["\u00a0\t a b \u3000\n", "\u200bx\u200b", "", "\x1f \x85y", None]
    assert values(spark, rows, text.utrim) == ["a b", "\u200bx\u200b", "", "y", None]


def test_regular_expression_and_list_of_white_space_agree(spark):
    chars = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    gone = values(spark, chars, text.remove_white_space)
    assert [c for c, left in zip(chars, gone) if left == ""] == [c for c in chars if c.isspace()]
    assert sorted(text.WHITE_SPACE) == [c for c in chars if c.isspace()]


def test_words(spark):
    assert values(spark, ["  a\u00a0b \n c ", "", " \t", "x"], text.words) == [["a", "b", "c"], [], [], ["x"]]


def test_cut_counts_code_points_and_marks_only_longer_texts(spark):
    rows = ["a" * 599, "a" * 600, "a" * 601, "a" * 599 + " b", "😀" * 601]
    got = values(spark, rows, lambda c: text.cut_with_dots(c, 600))
    assert got == ["a" * 599, "a" * 600, "a" * 600 + "...", "a" * 599 + "...", "😀" * 600 + "..."]
    assert values(spark, ["abc  d", "ab"], lambda c: text.cut(c, 4)) == ["abc", "ab"]


def test_one_line_and_preview(spark):
    assert values(spark, [" a\nb\n", None], text.one_line) == ["a b", ""]
    assert values(spark, ["x" * 199, "x" * 200, "x" * 201], text.preview) == ["x" * 199, "x" * 200 + "...", "x" * 200 + "..."]


def test_loose_and_strict_normalisation(spark):
    rows = ["a, b", "a - b", "Hello !", "", None, "!!!", "! !", "A\u00a0-\u00a0B?"]
    assert values(spark, rows, text.normalise_loose) == ["a,b", "ab", "hello", "", "", "!!!", "", "ab?"]
    assert values(spark, rows, text.normalise_strict) == ["ab", "ab", "hello", "", "", "", "", "ab"]


def test_every_ascii_punctuation_character_is_removed(spark):
    import string

    assert values(spark, list(string.punctuation), text.normalise_strict) == [""] * 32
    assert values(spark, ["я№1"], text.normalise_strict) == ["я№1"]


def test_json_string_escapes(spark):
    rows = [chr(c) for c in range(1, 0x100)] + ["\\" * k + "u001F" + c for k in range(4) for c in "\x1f\\\x0b"]
    rows += ["Уулын \"x\" a/b 😀 \u2028", ""]
    assert values(spark, rows, json_string) == [json.dumps(r, ensure_ascii=False) for r in rows]
    assert values(spark, [None], json_string) == ['""']


def test_json_spacing(spark):
    got = values(spark, ["q"], lambda c: json_array(F.array(json_object(name=json_string(c), url=json_string(c)))))
    assert got == ['[{"name": "q", "url": "q"}]']


def test_one_json_value(spark):
    rows = ['{"a":1}', '{"a":1} x', '{"a":1}}', "{", '{"a": 1}, {"b": 2}', '[1]', "  ", '{"a":"\\u00e9"}']
    assert values(spark, rows, is_one_json_value) == [True, False, False, False, False, True, False, True]
