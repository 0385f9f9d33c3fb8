"""Quality classifier by importance resampling over hashed n-gram models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.llm.common import id_text, store
from qaloom.llm.hashing import MARK_BYTES, blocks, hashed_words, pair

BUCKETS = 1 << 15
_PARTS = 1 << 16  # parts of the keys' range told apart in one pass


def _ngrams(group: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every 1-gram and 2-gram; letters and marks are words of their own, A-Z lower-cased."""
    words, owner, _, _ = hashed_words([b.lower() for b in group], MARK_BYTES)
    follows = owner[1:] == owner[:-1]
    grams = np.concatenate([words, pair(words[:-1], words[1:])[follows]])
    return (grams % np.uint64(buckets)).astype(np.int64), np.concatenate([owner, owner[1:][follows]])


def ngram_counts(docs: DataFrame, target_ids: frozenset[int], *, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over the target documents and over all documents; a task sends one row per bucket at most."""
    shared = docs.sparkSession.sparkContext.broadcast(target_ids)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, target, raw = shared.value, np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            inside = np.array([d in wanted for d in batch.column(0).to_pylist()], bool)
            for first, group in blocks(b.as_py() for b in batch.column(1)):
                grams, owner = _ngrams(group, buckets)
                raw += np.bincount(grams, minlength=buckets)
                target += np.bincount(grams[inside[first + owner]], minlength=buckets)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(target[some]), pa.array(raw[some])], ["bucket", "target", "raw"])

    rows = id_text(docs, id_col, text_col).mapInArrow(count, "bucket int, target bigint, raw bigint")
    total = rows.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toArrow()
    target, raw = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    at = total.column("bucket").to_numpy()
    target[at], raw[at] = total.column("target").to_numpy(), total.column("raw").to_numpy()
    return target, raw


def log_ratio(target: np.ndarray, raw: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """log p_target - log p_raw per bucket, both smoothed towards the raw model's shares (no target text: zero)."""
    share = (raw + smoothing) / (raw.sum() + smoothing * len(raw))
    if target.sum() == 0:
        return np.zeros(len(raw))
    pull = smoothing * len(raw)
    return np.log((target + pull * share) / (target.sum() + pull)) - np.log(share)


def log_weights(docs: DataFrame, ratio: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_grams, log_weight``: the sum of the log ratios of all n-grams of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shared.value
        for batch in batches:
            sums, sizes = np.zeros(len(batch.column(0))), np.zeros(len(batch.column(0)), np.int64)
            for first, group in blocks(b.as_py() for b in batch.column(1)):
                grams, owner = _ngrams(group, len(ratio))
                sums[first : first + len(group)] = np.bincount(owner, ratio[grams], len(group))
                sizes[first : first + len(group)] = np.bincount(owner, minlength=len(group))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(sums)], ["doc_id", "n_grams", "log_weight"])

    return id_text(docs, id_col, text_col).mapInArrow(weigh, "doc_id bigint, n_grams bigint, log_weight double")


def gumbel(seed: int, *keys: Column) -> Column:
    """Standard Gumbel noise that depends on the keys and the seed only."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 12) + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def kth_greatest(keyed: DataFrame, k: int) -> float | None:
    """The k-th greatest value of ``key`` (double, finite, no nulls), or None where there are fewer rows.

    Found by counting: the range of the values is cut into 65,536 equal parts, the part with the k-th value is cut again,
    and so on until it holds one value. A part is described by its own least and greatest value, so the first and the last
    value of a range never stay together and every round gets closer, however far the values lie apart.
    """
    low, high, wanted = None, None, k
    while True:
        if low is None:
            part, within = F.lit(0), keyed
        else:
            within = keyed.where(F.col("key").between(low, high))
            scale = 0.25 if max(abs(low), abs(high)) > 1e300 else 1.0  # the range itself may exceed a double
            share = (F.col("key") * scale - low * scale) / (high * scale - low * scale)
            part = F.least(F.floor(share * _PARTS).cast("int"), F.lit(_PARTS - 1))
        counts = within.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
        found = None
        for row in sorted(counts.collect(), key=lambda r: -r.part):
            if row.n >= wanted:
                found = row
                break
            wanted -= row.n
        if found is None:
            return None
        if found.low == found.high:
            return found.low
        low, high = found.low, found.high


def top_k(keyed: DataFrame, k: int) -> DataFrame:
    """Adds ``kept`` for the ``k`` rows with the greatest ``key`` (double, finite, no nulls), and all that tie with the last."""
    if k <= 0:
        return keyed.withColumn("kept", F.lit(False))
    last = kth_greatest(keyed, k)
    return keyed.withColumn("kept", F.lit(True) if last is None else F.col("key") >= last)


def resample(
    docs: DataFrame, target_ids: DataFrame, *, share: float, max_target: int = 100_000, seed: int = 42,
    id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
) -> DataFrame:
    """``doc_id, n_grams, log_weight, key, kept``: a sample of ``share`` of the rows that is distributed like the target.

    The weight of a row is the ratio of two bags of hashed 1- and 2-grams, target over raw; adding Gumbel noise and
    taking the greatest keys samples without replacement in proportion to the weights. Raw counts cover all
    documents; the target is at most ``max_target`` of the ids in ``target_ids`` (column ``doc_id``), those with the
    least hash, so that they fit a broadcast. Null and empty texts weigh 1. Rows with equal id and weight have the
    same noise and are kept or left together, so ties can exceed the share; null ids share their noise.
    """
    some = target_ids.select("doc_id").dropna().distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_target)
    target, raw = ngram_counts(docs, frozenset(r.doc_id for r in some.toLocalIterator()), id_col=id_col, text_col=text_col, buckets=buckets)
    weighed = log_weights(docs, log_ratio(target, raw), id_col=id_col, text_col=text_col)
    keyed = store(weighed.withColumn("key", F.col("log_weight") + gumbel(seed, F.col("doc_id"))), "weights")
    return top_k(keyed, round(share * keyed.count()))


def quality_share(labels: DataFrame) -> float:
    """Share of good documents among all labelled ones (none labelled: all)."""
    row = labels.agg(F.avg(F.col("quality").cast("double")).alias("share")).first()
    return 1.0 if row.share is None else row.share
