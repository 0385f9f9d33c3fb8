import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from qaloom.operators import formats


def one(df):
    return df.collect()[0]


def test_text_and_qa(spark):
    assert one(formats.fmt_text(spark.createDataFrame([("a",)], "text string"))).text == "a<|endoftext|>"
    qa = spark.createDataFrame([(" Q?", "A\n")], "question string, answer string")
    assert one(formats.fmt_qa(qa)).text == "<|im_start|>user\n Q?<|im_end|>\n<|im_start|>assistant\nA\n<|im_end|>"


def test_preference_rows(spark):
    row = one(formats.fmt_dpo(spark.createDataFrame([("p", "c", "r")], "prompt string, chosen string, rejected string")))
    assert row.asDict() == {
        "prompt": "<|im_start|>user\np<|im_end|>\n<|im_start|>assistant\n", "chosen": "c<|im_end|>", "rejected": "r<|im_end|>",
    }


def test_tool_dialog_and_prompts(spark):
    df = spark.createDataFrame([("[T]", "q", "{C}", "[R]", "a")],
                               "tools_json string, question string, tool_call_json string, tool_response_json string, answer string")
    head = "<|im_start|>system\nS\n<tools>\n[T]\n</tools><|im_end|>\n<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n"
    call, tool = "<tool_call>{C}</tool_call>", "<|im_end|>\n<|im_start|>tool\n<tool_response>[R]</tool_response><|im_end|>\n<|im_start|>assistant\n"
    assert one(formats.fmt_tool_dialog(df, "S")).text == head + call + tool + "a<|im_end|>"
    first = formats.prompt_round1(df, "[T]", "S")
    assert one(first).prompt == head
    assert one(formats.prompt_round2(first.withColumn("tool_call", F.lit(call)))).prompt == head + call + tool
    assert one(formats.prompt_generate(df)).prompt == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n"


def test_null_is_refused_and_missing_columns_are_named(spark):
    with pytest.raises(PySparkException, match="null text"):
        formats.fmt_qa(spark.createDataFrame([("q", None)], "question string, answer string")).collect()
    with pytest.raises(ValueError, match="answer"):
        formats.fmt_qa(spark.createDataFrame([("q",)], "question string"))


def test_recover_prompt_and_answer(spark):
    text = "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\nfirst assistant\n second <|im_end|> rest"
    row = spark.createDataFrame([(text,)], "t string").select(
        formats.prompt_recover(F.col("t")).alias("p"), formats.answer_recover(F.col("t")).alias("a"),
        formats.answer_cut(F.col("t")).alias("cut"),
    ).collect()[0]
    assert row.p == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n"
    assert (row.a, row.cut) == ("second <|im_end|> rest", "<|im_start|>user\nq")


def test_tool_call_and_specification_are_json(spark):
    question = 'Хэн "x"\\?\n'
    call = spark.createDataFrame([(question,)], "q string").select(formats.tool_call_json(F.col("q")).alias("c")).collect()[0].c
    assert call == json.dumps({"name": "web_search", "arguments": {"query": question}}, ensure_ascii=False)
    assert json.dumps(json.loads(formats.TOOLS_JSON), ensure_ascii=False) == formats.TOOLS_JSON


def test_registry(spark):
    df = spark.createDataFrame([("a",)], "text string")
    assert one(formats.apply_format(df, "TEXT_DATA")).text.endswith("<|endoftext|>")
    assert one(formats.apply_format(df, "iam_data")).text == "a"
