"""Connected components of a graph given as links, for any number of vertices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.llm.common import store


def _to_least(links: DataFrame, larger_only: bool) -> DataFrame:
    """Links every neighbour of a vertex to the least vertex around it (``larger_only``: only larger neighbours)."""
    least = links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = links.join(least, "a")
    if larger_only:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``vertex, root`` for every vertex of the links ``a, b`` (bigint); the root is the least vertex reachable.

    Large-star and small-star steps in turns: each pulls neighbours to the least vertex seen, until every vertex
    hangs on its root. Every round is written to the shared scratch folder. No neighbourhood is ever collected: a
    step is a minimum per vertex and a join on the vertex, which Spark splits where a vertex has very many links.
    """
    edges = store(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_least(both, larger_only=True).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        small = _to_least(down, larger_only=False).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        edges = store(small.distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            roots = edges.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
            return roots.unionByName(edges.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct())
        before = now
    raise RuntimeError(f"components have not settled in {max_rounds} rounds")
