"""Consistent placement of rows into shards by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.llm.common import fresh_name

TABLE_SIZE = 65_537  # a prime, over a thousand slots for each of up to 64 shards


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """Slot -> index of its shard.

    Each shard prefers the slots in the order ``offset, offset + skip, ...`` modulo the prime ``size``, both numbers
    drawn from the md5 of its name, which is a permutation of all slots. The shards take turns; at its turn a shard
    claims its next preferred slot that is still free. Shard sizes differ by one slot at most, and a shard that
    joins or leaves moves few other slots.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, and each name once")
    if not _is_prime(size) or size < len(shards):
        raise ValueError("the table size must be a prime and no less than the number of shards")
    digests = [hashlib.md5(s.encode()).digest() for s in shards]
    at = [int.from_bytes(d[:8], "big") % size for d in digests]
    skip = [int.from_bytes(d[8:], "big") % (size - 1) + 1 for d in digests]
    slots, free, turn = [-1] * size, size, 0
    while free:
        while slots[at[turn]] >= 0:
            at[turn] = (at[turn] + skip[turn]) % size
        slots[at[turn]] = turn
        free -= 1
        turn = (turn + 1) % len(shards)
    return slots


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a string key: the first 32 bits of its md5 modulo the table size (null: the slot of '')."""
    return F.conv(F.substring(F.md5(F.coalesce(key, F.lit("")).cast("binary")), 1, 8), 16, 10).cast("bigint") % size


def slot_table(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """The lookup table as rows ``slot, shard, shard_name``: ``size`` rows, whatever the data."""
    text = ",".join(map(str, lookup_table(shards, size)))
    slots = spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("slot", "shard"))
    names = F.array(*[F.lit(s) for s in shards])
    return slots.select(F.col("slot").cast("bigint"), F.col("shard").cast("int"), names[F.col("shard").cast("int")].alias("shard_name"))


def assign(
    docs: DataFrame, shards: list[str], *, id_col: str = "doc_id", text_col: str = "text", size: int = TABLE_SIZE
) -> DataFrame:
    """``doc_id, n_bytes, slot, shard, shard_name`` for every row: a hash, a modulo and a broadcast table of fixed size.

    Rows are placed by id, so no shard depends on how often a source or a text occurs. A null id is placed by its
    text, which spreads such rows too; null text counts 0 bytes. Repeated rows go to the same shard. Nothing but the
    result is written and nothing is shuffled; only ids and text lengths leave the scan.
    """
    key = F.coalesce(docs[id_col].cast("string"), docs[text_col])
    placed = docs.select(
        docs[id_col].alias("doc_id"), F.coalesce(F.octet_length(docs[text_col]), F.lit(0)).cast("bigint").alias("n_bytes"),
        slot_of(key, size).alias("slot"),
    )
    table = slot_table(docs.sparkSession, shards, size)
    return placed.join(F.broadcast(table), "slot").select("doc_id", "n_bytes", "slot", "shard", "shard_name")


def shard_sizes(assigned: DataFrame) -> DataFrame:
    """Rows and bytes of each shard."""
    return assigned.groupBy("shard", "shard_name").agg(F.count("*").alias("n_docs"), F.sum("n_bytes").alias("n_bytes"))


def write_shards(
    docs: DataFrame, shards: list[str], path: str, *, id_col: str = "doc_id", text_col: str = "text", size: int = TABLE_SIZE
) -> str:
    """Writes the rows of ``docs`` with all their columns to one folder per shard, without a shuffle.

    Rows go where ``assign`` places them: by id, and rows without an id by their text. The folders are named
    ``<column>=<shard name>``; the column is returned, ``_shard`` unless ``docs`` has one of that name. An empty table
    leaves no folders.
    """
    slot, shard = fresh_name(docs, "slot"), fresh_name(docs, "shard")
    key = F.coalesce(docs[id_col].cast("string"), docs[text_col])
    table = slot_table(docs.sparkSession, shards, size).select(F.col("slot").alias(slot), F.col("shard_name").alias(shard))
    placed = docs.withColumn(slot, slot_of(key, size)).join(F.broadcast(table), slot).drop(slot)
    placed.write.partitionBy(shard).parquet(path)
    return shard
