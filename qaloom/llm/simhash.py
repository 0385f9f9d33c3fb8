"""Near duplicates by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.llm.common import fresh_name, id_text, store
from qaloom.llm.components import components

SHINGLE = 3
SEED = 42
DISTANCE = 2
CROWDED = 16  # fingerprints in one table slot from which the exact whole-fingerprint way is taken
_BLOCK = 1 << 16  # shingles whose bits are counted at a time


def fingerprint(body: bytes) -> int:
    """64-bit fingerprint of a text: bit set where over half of the shingle hashes have it (no words: 0)."""
    words = body.lower().split()  # on bytes: A-Z only, and the six ASCII white-space characters only
    n = max(len(words) - SHINGLE + 1, min(len(words), 1))
    if n == 0:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False)) if len(words) >= SHINGLE else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, _BLOCK):
        octets = hashes[i : i + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a bigint) of every row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(1)
            bits = np.fromiter((fingerprint(b.as_py()) for b in bodies), np.uint64, len(bodies))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], ["doc_id", "fp"])

    return id_text(docs, id_col, text_col).mapInArrow(compute, "doc_id bigint, fp bigint")


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _high(fp: Column) -> Column:
    return F.shiftrightunsigned(fp, 32)


def _low(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _bits(n: int) -> list[Column]:
    return [F.lit((1 << i) - (1 << 64) if i == 63 else 1 << i).cast("bigint") for i in range(n)]


def _slots(prints: DataFrame) -> DataFrame:
    """Table entries: a fingerprint under each of its two 32-bit segments."""
    segments = F.array(F.struct(F.lit(0).alias("seg"), _high(F.col("fp")).alias("key")), F.struct(F.lit(1).alias("seg"), _low(F.col("fp")).alias("key")))
    return prints.select("fp", F.explode(segments).alias("s")).select("fp", "s.seg", "s.key")


def _probes(prints: DataFrame) -> DataFrame:
    """Slots to look into. Of two fingerprints 2 bits apart at most, either the high segments differ in one bit at
    most or the low ones are equal: so the ball of radius 1 around the high segment and of radius 0 around the low."""
    high = F.array(_high(F.col("fp")), *[_high(F.col("fp")).bitwiseXOR(b) for b in _bits(32)])
    balls = F.concat(
        F.transform(high, lambda k: F.struct(F.lit(0).alias("seg"), k.alias("key"))),
        F.array(F.struct(F.lit(1).alias("seg"), _low(F.col("fp")).alias("key"))),
    )
    return prints.select("fp", F.explode(balls).alias("s")).select("fp", "s.seg", "s.key")


def links(prints: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``) that connect exactly those at most 2 bits apart.

    Main path: each fingerprint probes its slots, and the matches are verified on all 64 bits. A slot that holds more
    than ``crowded`` fingerprints (many copies that differ in the other segment) would give the square of its size in
    candidates. Fingerprints that look into such a slot are linked among themselves through balls of radius 1 around
    the whole fingerprint instead: two of them are at most 2 bits apart just if their balls share a value, so each
    is linked to the least one at the same value, at 65 rows per fingerprint. The others probe as before, and find the
    former too, since the slots they look into are small.
    """
    sizes = _slots(prints).groupBy("seg", "key").agg(F.count("*").alias("n"))
    full = store(sizes.where(F.col("n") > crowded).select("seg", "key"), "crowded")
    close = store(_probes(prints).join(full, ["seg", "key"], "left_semi").select("fp").distinct(), "close")
    sparse = prints.join(close, "fp", "left_anti")
    entries = _slots(prints).withColumnRenamed("fp", "b")
    pairs = _probes(sparse).join(entries, ["seg", "key"]).where("fp <> b").where(_distance(F.col("fp"), F.col("b")) <= DISTANCE)
    found = pairs.select(F.col("fp").alias("a"), "b")

    ball = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(b) for b in _bits(64)])
    around = close.select("fp", F.explode(ball).alias("value"))
    least = around.groupBy("value").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    shared = around.join(least, "value").where("fp <> b").where(_distance(F.col("fp"), F.col("b")) <= DISTANCE)
    return found.unionByName(shared.select(F.col("fp").alias("a"), "b")).distinct()


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of the rows, and of each distinct one its group (``root``) and the group's least id."""
    rows = store(fingerprints(docs, id_col=id_col, text_col=text_col), "prints")
    prints = store(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct_prints")
    found = store(links(prints.select("fp")), "near")
    roots = components(found)
    grouped = prints.join(roots.withColumnRenamed("vertex", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows, grouped.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Equal fingerprints are one vertex, so copies are never paired. ``component_id`` is the least id reachable over
    links of at most 2 bits. Null or wordless texts have fingerprint zero and link like any other. Rows with a null id get
    the component of their fingerprint (null if no row there has an id); repeated rows are returned as often as they come;
    other columns are ignored.
    """
    rows, labels = _grouped(docs, id_col, text_col)
    return rows.join(labels, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _fingerprint_of(text: Column) -> Column:
    @F.pandas_udf("bigint")
    def compute(bodies: pd.Series) -> pd.Series:
        bits = np.fromiter((fingerprint(b or b"") for b in bodies), np.uint64, len(bodies))
        return pd.Series(bits.view(np.int64))

    return compute.asNondeterministic()(text.cast("binary"))  # so that a filter on it does not compute it once more


def one_of_each_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, of which one per group of near duplicates: that with the least id.

    Of several rows with the group's least id one stays, so repeated rows go. Rows that only share their id are judged by
    their texts: different groups keep a row each. Rows without an id all stay. Null and wordless texts are one group.
    """
    rows, labels = _grouped(docs, id_col, text_col)
    least = rows.join(labels, "fp").where("doc_id = component_id").groupBy("root").agg(F.min("doc_id").alias("_id"), F.min("fp").alias("_print"))
    least = store(least, "least")
    # an id with several fingerprints needs the row's own one; nearly all have one, and need no second look at their text
    several = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi")
    several = store(several.select(F.col("doc_id").alias("_several")), "several")
    key, mark = docs[id_col].cast("bigint"), fresh_name(docs, "print")
    plain = docs.where(docs[id_col].isNotNull()).join(several, key == several["_several"], "left_anti")
    kept = plain.join(least, plain[id_col].cast("bigint") == least["_id"], "left_semi").dropDuplicates([id_col])
    marked = docs.join(several, key == several["_several"], "left_semi").withColumn(mark, _fingerprint_of(docs[text_col]))
    same = (marked[id_col].cast("bigint") == least["_id"]) & (marked[mark] == least["_print"])
    shared = marked.join(least, same, "left_semi").dropDuplicates([id_col, mark]).drop(mark)
    return kept.unionByName(shared).unionByName(docs.where(docs[id_col].isNull()))
