"""Row filters of the tool-use job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.functions.text import is_blank


def flt_blank_question(df: DataFrame, question: str = "question") -> DataFrame:
    """Drops rows whose question is null or only white space."""
    return df.where(~is_blank(F.col(question)))


def flt_blank_answer(df: DataFrame, require: bool = True, answer: str = "answer") -> DataFrame:
    """In ground-truth mode (``require``) drops rows without an answer, otherwise keeps all."""
    return df.where(~is_blank(F.col(answer))) if require else df


def has_results(response: Column) -> Column:
    """False for a null response and for null or empty results."""
    return F.coalesce(F.size(response["results"]), F.lit(0)) > 0


def flt_no_result(df: DataFrame, response: str = "response") -> DataFrame:
    """Drops rows without a usable search response."""
    return df.where(has_results(F.col(response)))
