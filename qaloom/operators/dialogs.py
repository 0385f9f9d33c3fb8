"""Question/answer pairs from turn tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.operators.order import with_next
from qaloom.schemas import require_columns


def pairs_from_dialog(turns: DataFrame) -> DataFrame:
    """Every user turn directly followed by an assistant turn: qa_id ("conv_id-turn"), conv_id, turn, question, answer."""
    require_columns(turns, "conv_id", "turn", "role", "text")
    ahead = with_next(turns, "conv_id", "turn", {"next_role": "role", "next_text": "text"})
    return ahead.where((F.col("role") == "user") & (F.col("next_role") == "assistant")).select(
        F.concat_ws("-", "conv_id", "turn").alias("qa_id"),
        "conv_id",
        "turn",
        F.col("text").alias("question"),
        F.col("next_text").alias("answer"),
    )
