"""First-seen and last-written rows per key with late materialisation.

The winner of every key is found on narrow rows (key digest and order value) in a map-side combined aggregate, so a key
that holds a third of the table reaches its task as one row per map task and no text is ever sorted or compared. The
winners' full rows are then fetched by digest and order value in one join: wide columns move once, and not at all where
adaptive execution broadcasts the winners.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDE = "decimal(38,0)"


def text_digest(c: str | Column) -> Column:
    """Fixed-size stand-in for a text as grouping and join key (null stays null)."""
    return F.unhex(F.sha2(c, 256))


def key_columns(df: DataFrame, keys: list[str]) -> list[Column]:
    """Grouping values of the keys: texts by their digest, all else as it is."""
    return [text_digest(k) if isinstance(df.schema[k].dataType, (T.StringType, T.BinaryType)) else F.col(k) for k in keys]


def packed(*parts: tuple[str | Column, int]) -> Column:
    """Several integers (value, bits), most significant first, as one number that sorts like their tuple.

    Values are below 2^bits; the sum of the bits is at most 126. Numbers of this type are updated in place by hash
    aggregates, which structs and strings are not.
    """
    if sum(bits for _, bits in parts) > 126:
        raise ValueError("more than 126 bits")
    total = F.lit(0).cast(WIDE)
    for value, bits in parts:
        number = F.col(value) if isinstance(value, str) else value
        total = ((total * F.lit(Decimal(1 << bits)).cast(WIDE)).cast(WIDE) + number.cast(WIDE)).cast(WIDE)
    return total


def first_seen(df: DataFrame, key: str | list[str], order: Column) -> DataFrame:
    """The row with the smallest ``order`` value per key.

    ``order`` is unique within a key and not null (an id, or ``packed`` integers); rows that tie all stay. Null keys are
    one key. The input is read twice: its key and order, then the winners' rows.
    """
    return _extreme(df, key, order, F.min)


def last_written(df: DataFrame, key: str | list[str], order: Column) -> DataFrame:
    """The row with the largest ``order`` value per key; otherwise as ``first_seen``."""
    return _extreme(df, key, order, F.max)


def _extreme(df: DataFrame, key: str | list[str], order: Column, pick) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    names = [f"_k{i}" for i in range(len(keys))]
    digests = [c.alias(n) for c, n in zip(key_columns(df, keys), names, strict=True)]
    narrow = df.select(*digests, order.alias("_o"))
    winners = narrow.groupBy(*names).agg(pick("_o").alias("_w")).select(*[F.col(n).alias(f"_w{n}") for n in names], "_w")
    rows = df.select("*", *digests, order.alias("_o"))
    same = [F.col(n).eqNullSafe(F.col(f"_w{n}")) for n in names] + [F.col("_o") == F.col("_w")]
    return rows.join(winners, same, "left_semi").select(*df.columns)


def distinct_rows(df: DataFrame, *key: str) -> DataFrame:
    """Set semantics where it does not matter which copy stays."""
    return df.dropDuplicates(list(key)) if key else df.distinct()
