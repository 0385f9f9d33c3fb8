"""Table, JSON, CSV and snapshot sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.sources.files import path_exists

VERSION_FILE = "_input_version"


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_splits(df: DataFrame, path: str, version: str | None = None) -> str:
    """One folder per split, in one job, with the ``version`` of the input beside them.

    Rows are gathered by split into files of useful size; adaptive execution divides the large splits. The
    version is written last, so an unfinished write is never taken for this version.
    """
    df.hint("rebalance", "split").write.mode("overwrite").partitionBy("split").parquet(path)
    if version is not None:
        _record_version(df.sparkSession, path, version)
    return path


def append_jsonl(df: DataFrame, path: str) -> str:
    """Appends rows as JSON lines (the response log); empty and null fields are kept."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)
    return path


def write_jsonl(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def write_audit_json(audit: DataFrame, path: str) -> str:
    """Audit rows as JSON lines, a null drop reason included."""
    return write_jsonl(audit, path)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def publish_snapshot(df: DataFrame, path: str, version: str) -> DataFrame:
    """Writes an immutable versioned copy and returns its manifest (version, rows, columns)."""
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/version={version}"
    if path_exists(spark, f"{target}/_SUCCESS"):
        raise FileExistsError(f"version {version!r} is already published at {target}")
    df.write.mode("overwrite").parquet(target)
    manifest = spark.read.parquet(target).agg(F.count("*").alias("n_rows")).select(
        F.lit(version).alias("version"), "n_rows", F.array(*[F.lit(c) for c in df.columns]).alias("columns")
    )
    manifest.write.mode("overwrite").json(f"{path.rstrip('/')}/manifest={version}")
    return manifest


def _record_version(spark: SparkSession, path: str, version: str) -> None:
    # names with a leading underscore are not data to Parquet readers
    marker = spark.range(1).select(F.lit(version).alias("value")).coalesce(1)
    marker.write.mode("overwrite").text(f"{path}/{VERSION_FILE}")


def recorded_version(spark: SparkSession, path: str) -> str | None:
    """Input version of a finished stored table, or None."""
    marker = f"{path}/{VERSION_FILE}"
    if not (path_exists(spark, f"{path}/_SUCCESS") and path_exists(spark, marker)):
        return None
    return spark.read.text(marker).first()["value"]


def stage_resume(spark: SparkSession, path: str, input_version: str, build) -> tuple[DataFrame, bool]:
    """(stage table, reused). The stored table is reused only if it is complete and was built from
    the same input version; otherwise ``build()`` is run and stored."""
    if recorded_version(spark, path) == input_version:
        return spark.read.parquet(path), True
    build().write.mode("overwrite").parquet(path)
    _record_version(spark, path, input_version)
    return spark.read.parquet(path), False
