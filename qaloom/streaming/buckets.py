"""Tables that grow by micro-batches: bucketed runs, a manifest that names the live ones, and compaction of closed runs.

Layout below the table's folder: ``<part>/run=<name>/bucket=<k>/`` with the rows of one micro-batch (or of several folded
ones), and ``manifest/<version>/`` with one line of JSON. A run counts only once a manifest names it, and the manifest is
written last, so an interrupted batch leaves nothing that is read, and a batch that comes again is recognised.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.sources.files import list_names, path_exists, remove_path

BUCKETS = 64
FANOUT = 4  # closed runs of one tier that are folded into one of the next


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class BucketTable:
    """One growing table of named parts, each with its schema (without ``run`` and ``bucket``).

    A folder per micro-batch would make every read slower than the one before. Here runs have tiers: ``FANOUT`` runs of a
    tier are folded into one of the next, so n batches leave about FANOUT * log(n) runs, and a row is rewritten log(n) times.
    """

    def __init__(self, spark: SparkSession, path: str, parts: dict[str, T.StructType], buckets: int = BUCKETS, fanout: int = FANOUT):
        self.spark, self.path, self.parts, self.buckets, self.fanout = spark, path.rstrip("/"), parts, buckets, fanout

    def versions(self) -> list[str]:
        found = list_names(self.spark, f"{self.path}/manifest")
        return [v for v in found if path_exists(self.spark, f"{self.path}/manifest/{v}/_SUCCESS")]

    def manifest(self, version: str | None = None) -> dict:
        """version, last_batch and live runs (name, tier, rows); of a new table -1, -1 and none."""
        versions = self.versions() if version is None else [version]
        if not versions:
            return {"version": -1, "last_batch": -1, "runs": []}
        return json.loads(self.spark.read.text(f"{self.path}/manifest/{versions[-1]}").first()["value"])

    def done(self, batch_id: int) -> bool:
        """Whether this micro-batch is already part of the table (it is repeated after a failure)."""
        return batch_id <= self.manifest()["last_batch"]

    def write(self, part: str, name: str, rows: DataFrame) -> DataFrame:
        """Writes the rows (with ``bucket``) of a run that is not live yet, and reads them back."""
        path = f"{self.path}/{part}/run={name}"
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        return self._read(part, [name])

    def commit(self, batch_id: int, name: str, rows: int = 0) -> None:
        """Makes the runs called ``name`` of all parts live; the last step of a micro-batch."""
        state = self.manifest()
        runs = [*state["runs"], {"name": name, "tier": 0, "rows": rows}]
        self._publish(state["version"] + 1, batch_id, runs)

    def compact(self, fold: dict[str, Callable[[DataFrame, list[dict]], DataFrame]]) -> bool:
        """Folds the runs of the lowest full tier into one of the next tier; whether there was one.

        ``fold`` gives per part the rows (with ``bucket``) that stand for those of several runs.
        """
        state = self.manifest()
        for tier in sorted({r["tier"] for r in state["runs"]}):
            closed = [r for r in state["runs"] if r["tier"] == tier]
            if len(closed) >= self.fanout:
                name = f"{closed[-1]['name']}-t{tier + 1}"
                for part, rows in fold.items():
                    self.write(part, name, rows(self._read(part, [r["name"] for r in closed]), closed))
                merged = {"name": name, "tier": tier + 1, "rows": sum(r["rows"] for r in closed)}
                self._publish(state["version"] + 1, state["last_batch"], [merged, *[r for r in state["runs"] if r not in closed]])
                return True
        return False

    def read(self, part: str, only: list[int] | None = None) -> DataFrame:
        """Rows of all live runs with ``run`` and ``bucket``; with ``only`` just those buckets' files are listed and read."""
        rows = self._read(part, [r["name"] for r in self.manifest()["runs"]])
        return rows if only is None else rows.where(F.col("bucket").isin(only) if only else F.lit(False))

    def _read(self, part: str, names: list[str]) -> DataFrame:
        schema = T.StructType([*self.parts[part].fields, T.StructField("run", T.StringType()), T.StructField("bucket", T.IntegerType())])
        if not names:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/{part}/run={n}" for n in names]
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{part}").parquet(*paths)

    def _publish(self, version: int, last_batch: int, runs: list[dict]) -> None:
        line = json.dumps({"version": version, "last_batch": last_batch, "runs": runs})
        target = f"{self.path}/manifest/{version:012d}"
        self.spark.range(1).select(F.lit(line).alias("value")).coalesce(1).write.mode("overwrite").text(target)
        self._forget(version)

    def _forget(self, version: int) -> None:
        """Removes manifests before the last one, and runs that neither it nor the new one names: a reader that has just
        opened the table may still use the former."""
        kept = {r["name"] for v in self.versions()[-2:] for r in self.manifest(v)["runs"]}
        for old in self.versions()[:-2]:
            remove_path(self.spark, f"{self.path}/manifest/{old}")
        for part in self.parts:
            for folder in list_names(self.spark, f"{self.path}/{part}"):
                if folder.removeprefix("run=") not in kept:
                    remove_path(self.spark, f"{self.path}/{part}/{folder}")


# ------------------------------------------------------------------------------ Bloom filters, one per run and bucket

WORDS = 8  # 32-bit words of a block; a key sets one bit in each
BITS_PER_KEY = 16
FILTERS = T.StructType([T.StructField("block", T.LongType()), *[T.StructField(f"w{i}", T.LongType()) for i in range(WORDS)]])


def filter_blocks(rows: int, buckets: int) -> int:
    """Blocks of each bucket's filter in a run of ``rows`` keys."""
    return max(1, -(-rows * BITS_PER_KEY // (32 * WORDS * buckets)))


def _bits(key: Column) -> list[Column]:
    """One bit number per word: consecutive groups of five bits of a second hash of the key."""
    h = F.xxhash64(F.lit(1), key)
    return [F.shiftrightunsigned(h, 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(WORDS)]


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(2), key), blocks)


def bloom_rows(keys: DataFrame, blocks: int) -> DataFrame:
    """Filter blocks of ``key, bucket`` rows: a grouped bit-wise or, each block one small row."""
    placed = keys.select("bucket", _block(F.col("key"), F.lit(blocks)).alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(_bits(F.col("key")))])
    return placed.groupBy("bucket", "block").agg(*[F.bit_or(F.expr(f"shiftleft(1L, b{i})")).alias(f"w{i}") for i in range(WORDS)])


def maybe_seen(keys: DataFrame, filters: DataFrame, runs: list[dict], buckets: int) -> DataFrame:
    """The ``key, bucket`` rows that some run's filter may hold: every key reads one block per run."""
    if not runs:
        return keys.where(F.lit(False))
    sizes = F.array(*[F.struct(F.lit(r["name"]).alias("run"), F.lit(filter_blocks(r["rows"], buckets)).cast("bigint").alias("blocks")) for r in runs])
    probes = keys.withColumn("r", F.explode(sizes)).select("key", "bucket", F.col("r.run").alias("run"), _block(F.col("key"), F.col("r.blocks")).alias("block"))
    found = probes.join(filters, ["run", "bucket", "block"])
    for i, bit in enumerate(_bits(F.col("key"))):
        found = found.withColumn(f"_b{i}", bit).where(F.expr(f"shiftright(w{i}, _b{i}) & 1 = 1"))
    return found.select("key", "bucket").distinct()
