"""Hook for a user-supplied batch model (generate, encode); no model is shipped."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_batches(df: DataFrame, fn: Callable, batch_size: int, schema: str | T.StructType) -> DataFrame:
    """Applies ``fn(pandas frame) -> pandas frame`` to batches of at most ``batch_size`` rows.

    Runs inside the tasks over Arrow batches; rows keep their partition. A task holds what the session's Arrow limits on
    rows and bytes let through at a time, however many rows follow. Text columns wait in it as UTF-8 and are decoded for
    one batch of ``fn`` only, as decoded text takes up to four bytes a character.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]

    def decoded(part: pd.DataFrame) -> pd.DataFrame:
        return part.assign(**{c: pd.Series([None if t is None else t.decode() for t in part[c]], part.index) for c in texts})

    def run(frames: Iterator) -> Iterator:
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                yield fn(decoded(frame.iloc[start:start + batch_size]))

    return df.withColumns({c: df[c].cast("binary") for c in texts}).mapInPandas(run, schema)


def map_texts(df: DataFrame, columns: dict[str, str], fn: Callable, batch_size: int, element: T.DataType) -> DataFrame:
    """Adds, per ``target: source``, target = ``fn(list of source texts)``, called with ``batch_size`` texts at most.

    Only the source columns are sent to Python, all of them in one pass; the other columns stay in the JVM. How much is
    sent at a time follows the session's Arrow limits on rows and bytes. ``fn`` returns one value of type ``element`` per
    text, in order; it is not run again for columns derived from its result.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            texts = [t for row in rows for t in row]
            values = []
            for start in range(0, len(texts), batch_size):
                part = texts[start:start + batch_size]
                answers = list(fn(part))
                if len(answers) != len(part):
                    raise ValueError(f"batch function returned {len(answers)} values for {len(part)} rows")
                values.extend(answers)
            yield pd.Series([values[i:i + width] for i in range(0, len(values), width)], dtype=object)

    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    width = len(columns)
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    model = F.pandas_udf(run, T.ArrayType(element)).asNondeterministic()
    answered = df.withColumn("_answers", model(F.array(*columns.values())))
    return answered.select(*df.columns, *[F.get("_answers", F.lit(i)).alias(target) for i, target in enumerate(columns)])


def map_text(df: DataFrame, source: str, target: str, fn: Callable, batch_size: int, element: T.DataType) -> DataFrame:
    """``map_texts`` for one column."""
    return map_texts(df, {target: source}, fn, batch_size, element)
