"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.session import scratch_dir

# Words everywhere in this subpackage: runs of bytes other than the six ASCII white-space characters.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
# Unicode white space, for use inside a character class of Python's re.
UNICODE_WS = r"\t-\r \x85\xa0  -     　"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared scratch folder and reads it back: computed once, and no executor has to survive."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use, whatever the case of its names."""
    taken, name = {c.lower() for c in df.columns}, f"_{base}"
    while name in taken:
        name = f"_{name}"
    return name


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and whole text (null: empty, as UTF-8 bytes), whatever other columns there are."""
    return docs.select(
        docs[id_col].cast("bigint").alias("doc_id"),
        F.coalesce(docs[text_col].cast("binary"), F.lit(b"").cast("binary")).alias("body"),
    )


def word_array(text):
    """SQL array of the words of a text (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")
