"""Preference pairs: similarity scores, threshold, audit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.functions.overlap import ngram_matches
from qaloom.functions.text import remove_white_space, token_count, utrim
from qaloom.functions.vectors import dot, l2_normalise
from qaloom.operators.batches import map_text, map_texts
from qaloom.operators.formats import prompt_generate
from qaloom.operators.joins import hot_buckets, lookup
from qaloom.operators.profiling import length_table
from qaloom.schemas import require_columns

# Score weights, drop threshold, n-gram order, recall weight, model batch sizes.
COSINE_WEIGHT = 0.7
CHRF_WEIGHT = 0.3
THRESHOLD = 0.85
CHAR_ORDER = 6
BETA = 2.0
GENERATE_BATCH = 16
EMBED_BATCH = 32
DROP_REASON = "too_similar (score>={})"

MIN_HOT_ROWS = 10_000  # pointers to vectors of one key bucket before they are spread


def generate_rejected(qa: DataFrame, generate: Callable, batch_size: int = GENERATE_BATCH) -> DataFrame:
    """prompt, chosen, rejected (and the other columns) from question, answer.

    ``generate`` maps a list of open chat prompts to a list of answers, which are trimmed.
    """
    prompted = qa.transform(prompt_generate)
    answered = map_text(prompted, "prompt", "rejected", generate, batch_size, T.StringType())
    return answered.withColumn("rejected", utrim(F.col("rejected"))).drop("prompt").withColumnsRenamed(
        {"question": "prompt", "answer": "chosen"}
    )


def embed_sides(pairs: DataFrame, embed: Callable, batch_size: int = EMBED_BATCH) -> DataFrame:
    """Adds unit vectors ``chosen_vec`` and ``rejected_vec``; ``embed`` maps a list of texts to vectors."""
    out = map_texts(pairs, {"chosen_vec": "chosen", "rejected_vec": "rejected"}, embed, batch_size, T.ArrayType(T.DoubleType()))
    return out.withColumns({c: l2_normalise(F.col(c)) for c in ("chosen_vec", "rejected_vec")})


def join_vectors(pairs: DataFrame, vectors: DataFrame, id_col: str, sides: dict[str, str],
                 vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Attaches one vector column per side; ``sides`` maps the new column to the pair's vector id column.

    Many pairs may point at one vector (a stock answer), hence the skew-proof lookup. Hot pointers are counted once, over
    all sides together.
    """
    out = pairs
    pointers = pairs.select(F.explode(F.array(*sides.values())).alias("_vid"))
    hot = hot_buckets(pointers, "_vid", MIN_HOT_ROWS)
    for name, pointer in sides.items():
        side = vectors.select(F.col(vec_id).alias("_vid"), F.col(embedding).alias(name))
        out = lookup(out, side, pointer, "_vid", id_col, hot=hot)
    return out


def cosine(df: DataFrame, a: str = "chosen_vec", b: str = "rejected_vec", name: str = "cosine") -> DataFrame:
    """Dot product of two unit vectors."""
    return df.withColumn(name, dot(F.col(a), F.col(b)))


def chrf(df: DataFrame, hyp: str = "rejected", ref: str = "chosen", order: int = CHAR_ORDER, beta: float = BETA,
         name: str = "chrf") -> DataFrame:
    """Character n-gram F-score in 0..1 (Popovic 2015), white space ignored, case kept.

    Precision and recall are averaged over the orders for which both sides have n-grams.
    """
    h, r = F.col("_hyp"), F.col("_ref")
    scored = df.withColumns({
        "_hyp": remove_white_space(F.coalesce(hyp, F.lit(""))),
        "_ref": remove_white_space(F.coalesce(ref, F.lit(""))),
    })
    scored = scored.withColumn("_m", ngram_matches(h, r, order))
    # order n has n-grams on both sides iff both have at least n characters
    orders = F.nullif(F.least(F.length(h), F.length(r), F.lit(order)), F.lit(0))
    scored = scored.withColumns({
        "_p": _sum_of_ratios(F.col("_m"), F.length(h)) / orders,
        "_r": _sum_of_ratios(F.col("_m"), F.length(r)) / orders,
    })
    p, q, b2 = F.col("_p"), F.col("_r"), beta * beta
    score = F.when(p + q > 0, (1 + b2) * p * q / (b2 * p + q)).otherwise(F.lit(0.0))
    return scored.withColumn(name, score).drop("_hyp", "_ref", "_m", "_p", "_r")


def _sum_of_ratios(matches: Column, chars: Column) -> Column:
    """Sum over the orders n of matches / n-grams; a text of ``chars`` characters has chars - n + 1."""
    ratios = F.transform(matches, lambda m, i: F.when(chars > i, m / (chars - i)).otherwise(F.lit(0.0)))
    return F.aggregate(ratios, F.lit(0.0), lambda total, x: total + x)


def combined_score(df: DataFrame, weights: tuple[float, float] = (COSINE_WEIGHT, CHRF_WEIGHT)) -> DataFrame:
    return df.withColumn("score", F.lit(weights[0]) * F.col("cosine") + F.lit(weights[1]) * F.col("chrf"))


def flag_similar(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``kept`` and ``drop_reason``; a score on the threshold is dropped."""
    too_similar = F.col("score") >= threshold
    return df.withColumns({
        "kept": ~too_similar,
        "drop_reason": F.when(too_similar, DROP_REASON.format(threshold)),
    })


def pref_audit(df: DataFrame, weights: tuple[float, float] = (COSINE_WEIGHT, CHRF_WEIGHT),
               threshold: float = THRESHOLD) -> DataFrame:
    """Scores and verdict for every pair that carries ``chosen_vec`` and ``rejected_vec``."""
    require_columns(df, "prompt", "chosen", "rejected", "chosen_vec", "rejected_vec")
    scored = df.transform(cosine).drop("chosen_vec", "rejected_vec").transform(chrf)
    return scored.transform(combined_score, weights).transform(flag_similar, threshold)


def kept_pairs(audit: DataFrame) -> DataFrame:
    return audit.where("kept").select("prompt", "chosen", "rejected")


def drop_counts(audit: DataFrame) -> DataFrame:
    """Rows per drop reason (kept rows under a null reason) plus a total row."""
    counts = audit.groupBy("kept", "drop_reason").agg(F.count("*").alias("n_rows"))
    return (
        counts.select(F.when(F.col("kept"), "kept").otherwise(F.col("drop_reason")).alias("outcome"), "n_rows")
        .groupBy("outcome").agg(F.sum("n_rows").alias("n_rows"))
        .rollup("outcome").agg(F.sum("n_rows").alias("n_rows"))
        .select(F.coalesce("outcome", F.lit("total")).alias("outcome"), "n_rows")
    )


def length_bias(df: DataFrame, *by: str, method: str = "whitespace") -> DataFrame:
    """Total, average, shortest, longest and median token length of the three texts side by side, in one pass."""
    texts = ("prompt", "chosen", "rejected")
    lengths = length_table(df, {c: token_count(F.col(c), method) for c in texts}, by)
    aggs = [F.sum(F.when(F.col("text") == texts[0], F.col("n"))).alias("n_rows")]
    for c in texts:
        tokens, rows = F.when(F.col("text") == c, F.col("tokens")), F.when(F.col("text") == c, F.col("n"))
        aggs += [
            F.sum(tokens * rows).alias(f"{c}_total"),
            F.bround(F.sum(tokens * rows) / F.sum(rows), 1).alias(f"{c}_avg"),
            F.min(tokens).alias(f"{c}_min"),
            F.max(tokens).alias(f"{c}_max"),
            F.percentile(tokens, F.lit(0.5), F.col("n")).alias(f"{c}_median"),
        ]
    return lengths.groupBy(*by).agg(*aggs)
