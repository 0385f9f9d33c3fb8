"""Chat-format projections. All inputs are strings; null inputs are rejected, not rendered as text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.functions.jsontext import json_object, json_string
from qaloom.functions.text import preview, utrim
from qaloom.schemas import require_columns

# Chat markers, end-of-text marker, system message and tool specification.
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
END_OF_TEXT = "<|endoftext|>"
ASSISTANT_HEADER = "<|im_start|>assistant\n"
TOOLS_JSON = (
    '[{"name": "web_search", "description": "Интернетээс хайлт хийж, шинэлэг мэдээлэл авах. '
    'Хайлтын асуултыг богино, ойлгомжтой бичих.", "parameters": {"type": "object", "properties": '
    '{"query": {"type": "string", "description": "Хайх асуулт (Монгол эсвэл Англи хэлээр)"}}, '
    '"required": ["query"]}}]'
)
SYSTEM_MESSAGE = "Та хэрэглэгчид туслахын тулд дараах хэрэгслүүдийг ашиглаж болно."
TOOL_NAME = "web_search"


def _text(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isNotNull(), col).otherwise(F.raise_error(F.lit("null text in a chat field")).cast("string"))


def _turn(role: str, *body: Column | str) -> list[Column]:
    """Pieces of one closed turn, without the line break that separates it from the next."""
    return [F.lit(f"{IM_START}{role}\n"), *[F.lit(b) if isinstance(b, str) else b for b in body], F.lit(IM_END)]


def _user_then_assistant(question: Column) -> list[Column]:
    return [*_turn("user", question), F.lit("\n" + ASSISTANT_HEADER)]


def _system_with_tools(tools: Column, system_message: str) -> list[Column]:
    return _turn("system", f"{system_message}\n<tools>\n", tools, "\n</tools>")


def fmt_text(df: DataFrame, eos: str = END_OF_TEXT) -> DataFrame:
    """text followed by the end-of-text marker."""
    require_columns(df, "text")
    return df.withColumn("text", F.concat(_text("text"), F.lit(eos)))


def fmt_qa(df: DataFrame) -> DataFrame:
    """Adds ``text``: one user turn and one assistant turn."""
    require_columns(df, "question", "answer")
    return df.withColumn("text", F.concat(*_user_then_assistant(_text("question")), _text("answer"), F.lit(IM_END)))


def fmt_dpo(df: DataFrame) -> DataFrame:
    """Opens the assistant turn in ``prompt`` and closes it in ``chosen`` and ``rejected``."""
    require_columns(df, "prompt", "chosen", "rejected")
    return df.withColumns({
        "prompt": F.concat(*_user_then_assistant(_text("prompt"))),
        "chosen": F.concat(_text("chosen"), F.lit(IM_END)),
        "rejected": F.concat(_text("rejected"), F.lit(IM_END)),
    })


def fmt_tool_dialog(df: DataFrame, system_message: str = SYSTEM_MESSAGE) -> DataFrame:
    """Adds ``text``: system with tools, user, tool call, tool response, final answer."""
    require_columns(df, "tools_json", "question", "tool_call_json", "tool_response_json", "answer")
    turns = [
        _system_with_tools(_text("tools_json"), system_message),
        _turn("user", _text("question")),
        _turn("assistant", "<tool_call>", _text("tool_call_json"), "</tool_call>"),
        _turn("tool", "<tool_response>", _text("tool_response_json"), "</tool_response>"),
        _turn("assistant", _text("answer")),
    ]
    pieces: list[Column] = []
    for i, turn in enumerate(turns):
        pieces += turn if i == 0 else [F.lit("\n"), *turn]
    return df.withColumn("text", F.concat(*pieces))


# Which format each dataset kind gets; None keeps the rows as they are.
FORMATS: dict[str, Callable[[DataFrame], DataFrame] | None] = {
    "text_data": fmt_text,
    "qa_data": fmt_qa,
    "dpo_data": fmt_dpo,
    "instruction_data": fmt_tool_dialog,
    "iam_data": None,
}


def apply_format(df: DataFrame, dataset: str) -> DataFrame:
    fmt = FORMATS[dataset.lower()]
    return df if fmt is None else df.transform(fmt)


def prompt_generate(df: DataFrame, question: str = "question") -> DataFrame:
    """Adds ``prompt``: user turn and an open assistant turn."""
    return df.withColumn("prompt", F.concat(*_user_then_assistant(_text(question))))


def prompt_round1(df: DataFrame, tools_json: str = TOOLS_JSON, system_message: str = SYSTEM_MESSAGE) -> DataFrame:
    """Adds ``prompt``: system with tools, user turn, open assistant turn."""
    system = _system_with_tools(F.lit(tools_json), system_message)
    return df.withColumn("prompt", F.concat(*system, F.lit("\n"), *_user_then_assistant(_text("question"))))


def prompt_round2(df: DataFrame) -> DataFrame:
    """Appends the model's call, the tool's response and an open assistant turn to ``prompt``."""
    require_columns(df, "prompt", "tool_call", "tool_response_json")
    tool = _turn("tool", "<tool_response>", _text("tool_response_json"), "</tool_response>")
    return df.withColumn(
        "prompt",
        F.concat(_text("prompt"), _text("tool_call"), F.lit(IM_END + "\n"), *tool, F.lit("\n" + ASSISTANT_HEADER)),
    )


def prompt_recover(text: Column) -> Column:
    """Prompt part of a formatted row: everything before the first assistant turn, which is reopened."""
    return F.concat(F.substring_index(text, ASSISTANT_HEADER, 1), F.lit(ASSISTANT_HEADER))


def answer_recover(text: Column) -> Column:
    """What follows the last assistant header of a decoded dialog, trimmed."""
    return utrim(F.substring_index(text, "assistant\n", -1))


def answer_cut(text: Column) -> Column:
    """Generated text up to its first end-of-turn marker, trimmed."""
    return utrim(F.substring_index(text, IM_END, 1))


def tool_call_json(query: Column) -> Column:
    """{"name": "web_search", "arguments": {"query": ...}}"""
    return json_object(name=F.lit(f'"{TOOL_NAME}"'), arguments=json_object(query=json_string(query)))


def preview_columns(df: DataFrame, *cols: str, chars: int = 200) -> DataFrame:
    """Display copies of long string columns."""
    return df.withColumns({c: preview(F.col(c), chars) for c in cols})
