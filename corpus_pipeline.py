"""From raw documents to packed training sequences: the stages, each written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from qaloom.llm import decontaminate, packing, simhash, substrings, toxicity
from qaloom.llm.common import store, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the chain, fitted on ``labels``, finds toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return simhash.one_of_each_group(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes passages that occur earlier out of the texts; documents of which nothing is left go."""
    return substrings.without_repeats(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, up to a tenth of its words edited."""
    return decontaminate.without_matches(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces of the remaining documents. Workers still hold what earlier stages left, so they remember less."""
    return packing.pack(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), cache_size=250_000)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", remove_repeats),
    ("benchmark decontamination", decontaminate_benchmark),
    ("best-fit packing", pack),
]
# Trained models, fingerprints and tokenizers are beyond SQL; tests/llm/test_pipeline.py holds every stage and run()
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store(docs, f"stage-{i}")
    return docs
