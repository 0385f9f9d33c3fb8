"""Fixed table schemas; sources are read with these so that no inference pass is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


TEXT = _strings("text")
QA = _strings("question", "answer")
DPO = _strings("prompt", "chosen", "rejected")
INSTRUCTION = _strings("tools_json", "question", "tool_call_json", "tool_response_json", "answer")
SEARCH_RESULT = _strings("title", "url", "content")
SEARCH_RESPONSE = T.StructType([
    T.StructField("answer", T.StringType()),
    T.StructField("results", T.ArrayType(SEARCH_RESULT)),
])
CACHE = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("response", SEARCH_RESPONSE),
])
RUN_METRIC = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("session", T.LongType()),
    T.StructField("step", T.LongType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


# What the raw table of each dataset kind must hold (further columns, such as an id, are kept).
DATASETS = {"text_data": TEXT, "qa_data": QA, "dpo_data": DPO, "instruction_data": INSTRUCTION}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The table unchanged, if it has every column of ``schema`` with its type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f"{f.name}: {types[f.name].simpleString() if f.name in types else 'missing'}, not {f.dataType.simpleString()}"
             for f in schema.fields if types.get(f.name) != f.dataType]
    if wrong:
        raise ValueError("table does not fit its schema: " + "; ".join(wrong))
    return df


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fail at plan time, with the missing names, instead of deep inside an expression."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; table has {df.columns}")
    return df
