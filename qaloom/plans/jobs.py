"""The end-to-end jobs: dataset loading, tool-use dataset, preference dataset, reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.operators import prefs, profiling, runlogs
from qaloom.operators.enrich import Enrichment
from qaloom.operators.formats import apply_format
from qaloom.operators.generate import sample_questions
from qaloom.operators.splits import split_table
from qaloom.sources.readers import has_splits, number_questions, read_cache, read_columnar, read_questions, read_splits, resolve, source_version
from qaloom.sources.writers import (
    recorded_version, stage_resume, write_audit_json, write_csv, write_jsonl, write_splits, write_table,
)


def load_dataset(spark: SparkSession, name: str, locations: dict[str, dict[str, str]],
                 sizes: dict[str, dict[str, int | None]], id_col: str, only_test: bool = False):
    """Resolve, split, format and materialise a dataset; later calls read the stored splits.

    They are built again once the source's files or the wanted sizes are others than those they were made
    from. Where only stored splits exist they are read as they are. Returns (train, validation), or the
    test table.
    """
    places, size = locations[name], sizes.get(name, {})
    sources = {k: v for k, v in places.items() if k != "mapped"}
    try:
        source, origin = resolve(spark, name, {name: sources})
    except FileNotFoundError:
        source, _ = resolve(spark, name, locations)
        df = source
    else:
        made_from = [source_version(spark, sources[origin]), size.get("test"), size.get("validation"), id_col]
        version = "/".join(map(str, made_from))
        if not has_splits(spark, places["mapped"]) or recorded_version(spark, places["mapped"]) != version:
            split = split_table(source, id_col, size.get("test"), size.get("validation"))
            write_splits(apply_format(split, name), places["mapped"], version)
        df = read_splits(spark, places["mapped"])
    parts = {s: df.where(F.col("split") == s).drop("split") for s in ("train", "validation", "test")}
    return parts["test"] if only_test else (parts["train"], parts["validation"])


def build_questions(grid: DataFrame, path: str, limit: int | None = None, seed: int = 42) -> str:
    """Writes the deduplicated questions, or a seeded sample of ``limit``, as JSON lines."""
    return write_jsonl(sample_questions(grid, limit, seed).select("question"), path)


def build_search_dataset(spark: SparkSession, cache_path: str, out: str, questions: DataFrame | None = None,
                         questions_path: str | None = None, limit: int | None = None, **options) -> DataFrame:
    """Writes the tool-use rows to ``out``, the questions still to be searched beside it as JSON lines,
    and returns the counters.

    With ``questions_path`` the questions come from a JSON-lines file, are numbered and stored beside
    the output first, answers are derived, and candidates are not oversampled; a question table needs
    id, question, answer and is oversampled twofold.
    """
    cache = read_cache(spark, cache_path)
    if questions_path is not None:
        numbered = number_questions(read_questions(spark, questions_path))
        # stored, so that every use of the numbers sees the same ones
        source = spark.read.parquet(write_table(numbered, f"{out}_questions"))
        defaults = {"require_answer": False, "oversample": 1}
    elif questions is not None:
        source, defaults = questions, {"require_answer": True, "oversample": 2}
    else:
        raise ValueError("give questions or questions_path")
    run = Enrichment(source, cache, limit=limit, **{**defaults, **options}).prepare()
    write_table(run.rows().drop(run.id_col), out)
    write_jsonl(run.missing(), f"{out}_to_search")
    counters = spark.read.parquet(write_table(run.counters(), f"{out}_counters"))
    run.release()
    return counters


def generate_pairs(qa: DataFrame, out: str, input_version: str, generate: Callable) -> DataFrame:
    """prompt, chosen, rejected; the costly generation is stored and reused for the same input version."""
    pairs, _ = stage_resume(qa.sparkSession, f"{out}/generated", input_version, lambda: prefs.generate_rejected(qa, generate))
    return pairs


def build_preference_dataset(pairs: DataFrame, out: str, threshold: float = prefs.THRESHOLD) -> DataFrame:
    """Scores once into a stored audit table; kept pairs, audit JSON and counts are read from it.

    ``pairs``: prompt, chosen, rejected, chosen_vec, rejected_vec.
    """
    spark = pairs.sparkSession
    audit_path = write_table(prefs.pref_audit(pairs, threshold=threshold), f"{out}/audit")
    audit = spark.read.parquet(audit_path)
    write_table(prefs.kept_pairs(audit), f"{out}/raw")
    write_audit_json(audit, f"{out}/audit_json")
    return prefs.drop_counts(audit)


def profile_datasets(spark: SparkSession, paths: dict[str, str], id_col: str, texts: dict[str, list[str]] | None = None,
                     cap: int | None = None) -> DataFrame:
    """Per stored dataset, split and text: path, columns, files, size and token statistics.

    ``texts`` names the text columns to profile per dataset; by default it is ``text``, which is made by the dataset's
    format where a table lacks it. Tables without splits have one line with a null split.
    """
    report = None
    for name, path in paths.items():
        df = read_columnar(spark, path)
        columns = F.array(*[F.lit(c) for c in df.columns])
        wanted = (texts or {}).get(name, ["text"])
        if wanted == ["text"] and "text" not in df.columns:
            df = apply_format(df, name)
        by = ("split",) if "split" in df.columns else ()
        stats, sizes = profiling.profile_texts(df, wanted, id_col, by, cap), profiling.size_mb(spark, path, *by)
        if by:
            part = stats.join(sizes, "split")
        else:
            whole = {c: sizes.select(c).scalar() for c in ("n_files", "size_mb")}
            part = stats.withColumns({"split": F.lit(None).cast("string"), **whole})
        part = part.withColumns({"dataset": F.lit(name), "path": F.lit(path), "columns": columns})
        report = part if report is None else report.unionByName(part)
    if report is None:
        raise ValueError("no datasets given")
    return report


def write_curve_reports(runs: DataFrame, out: str) -> None:
    """Loss curves and best evaluation losses as CSV."""
    write_csv(runlogs.run_curves(runs), f"{out}/loss_curves")
    best = runlogs.best_checkpoint(runs)
    write_csv(
        best.select(F.col("stage").alias("model_version"), F.lit("eval_loss_best").alias("metric_name"),
                    F.col("best_eval_loss").cast("string").alias("value")),
        f"{out}/eval_results",
    )
