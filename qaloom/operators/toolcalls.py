"""Tool-call extraction and validation on generated text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.functions.jsontext import is_one_json_value
from qaloom.functions.text import WS

# Fixed value: the first call block; the JSON object may span lines and is matched lazily.
CALL_BLOCK = rf"(?s)<tool_call>{WS}*(\{{.+?\}}){WS}*</tool_call>"


def tool_call_check(df: DataFrame, col: str = "output") -> DataFrame:
    """Adds ``raw_call`` (with tags), ``query`` and ``status``: none | bad_json | no_query | ok.

    An empty object counts as bad_json: there is nothing to call with.
    """
    body = F.regexp_extract(col, CALL_BLOCK, 1)
    wrapped = F.concat(F.lit('{"call": '), F.col("_body"), F.lit("}"))
    call = F.from_json(
        wrapped,
        "call string, _corrupt_record string",
        {"columnNameOfCorruptRecord": "_corrupt_record"},
    )
    empty = F.col("_body").rlike(rf"^\{{{WS}*\}}$")
    return (
        df.withColumn("_body", body)
        .withColumn("raw_call", F.nullif(F.regexp_extract(col, CALL_BLOCK, 0), F.lit("")))
        .withColumn("query", F.when(F.col("_body") != "", F.get_json_object("_body", "$.arguments.query")))
        .withColumn("_bad", ~is_one_json_value(F.col("_body")) | empty | call["_corrupt_record"].isNotNull())
        .withColumn(
            "status",
            F.when(F.col("_body") == "", "none").when(F.col("_bad"), "bad_json")
            .when(F.col("query").isNull(), "no_query").otherwise("ok"),
        )
        .withColumn("query", F.when(F.col("status") == "ok", F.col("query")))
        .drop("_body", "_bad")
    )


def tool_call_counts(checked: DataFrame, *by: str) -> DataFrame:
    return checked.groupBy(*by, "status").agg(F.count("*").alias("n_rows"))
