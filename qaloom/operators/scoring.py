"""Question-answering scores and perplexity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.functions.overlap import char_bag_overlap
from qaloom.functions.text import normalise_loose, normalise_strict, utrim
from qaloom.operators.joins import zip_by_id

NORMALISERS = {"char_loose": normalise_loose, "char_strict": normalise_strict}
IGNORED_LABEL = -100  # fixed value: label of masked tokens


def join_eval(predictions: DataFrame, references: DataFrame, id_col: str) -> DataFrame:
    """Predictions beside references, which must be of the same rows; ``joins.unmatched`` lists differences."""
    return zip_by_id(id_col, predictions, references)


def exact_match(prediction: Column, reference: Column, mode: str = "trim") -> Column:
    """1.0 or 0.0. "trim" compares trimmed texts, "normalised" the strict character sequences."""
    if mode == "trim":
        same = utrim(F.coalesce(prediction, F.lit(""))) == utrim(F.coalesce(reference, F.lit("")))
    elif mode == "normalised":
        same = normalise_strict(prediction) == normalise_strict(reference)
    else:
        raise ValueError(f"unknown exact-match mode {mode!r}")
    return F.when(same, 1.0).otherwise(0.0)


def qa_em(df: DataFrame, mode: str = "trim", name: str = "em") -> DataFrame:
    return df.withColumn(name, exact_match(F.col("prediction"), F.col("reference"), mode))


def qa_f1(df: DataFrame, mode: str = "char_loose", name: str = "f1") -> DataFrame:
    """F1 of the two character bags; 1.0 if both are empty, 0.0 if one is."""
    normalise = NORMALISERS[mode]
    out = df.withColumns({"_p": normalise(F.col("prediction")), "_r": normalise(F.col("reference"))})
    n_pred, n_ref = F.length("_p"), F.length("_r")
    out = out.withColumn("_same", char_bag_overlap(F.col("_p"), F.col("_r")))
    precision, recall = F.col("_same") / n_pred, F.col("_same") / n_ref
    f1 = (
        F.when((n_pred == 0) & (n_ref == 0), 1.0)
        .when((n_pred == 0) | (n_ref == 0) | (F.col("_same") == 0), 0.0)
        .otherwise(2 * precision * recall / (precision + recall))
    )
    return out.withColumn(name, f1).drop("_p", "_r", "_same")


def qa_scores(df: DataFrame, *by: str, em_mode: str = "trim", f1_mode: str = "char_loose") -> DataFrame:
    """Mean exact match and F1, as fraction and as percentage with two decimals."""
    scored = df.transform(qa_em, em_mode).transform(qa_f1, f1_mode)
    means = scored.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.avg("em").alias("exact_match"), F.avg("f1").alias("f1")
    )
    return means.withColumns({
        "exact_match_pct": F.bround(F.col("exact_match") * 100, 2),
        "f1_pct": F.bround(F.col("f1") * 100, 2),
    })


def perplexity(df: DataFrame, *by: str, nll: str = "nll", label: str = "label") -> DataFrame:
    """exp of the mean token loss over unmasked tokens; overflow gives infinity."""
    return (
        df.where(F.col(label) != IGNORED_LABEL)
        .groupBy(*by)
        .agg(F.count("*").alias("n_tokens"), F.avg(nll).alias("loss"))
        .withColumn("perplexity", F.exp("loss"))
    )
