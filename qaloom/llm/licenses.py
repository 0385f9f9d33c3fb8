"""License notices in texts by MinHash bands over overlapping windows."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.llm.license_texts import TEMPLATES

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 0.003  # most a band setting may miss of the windows that hold a match
MAX_SHINGLES = 2_000_000  # of all templates together: what is broadcast stays below a few hundred MB


def template_words(text: str) -> list[str]:
    """Runs of ASCII letters and digits in lower case, as in texts."""
    return re.findall("[a-z0-9]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def template_shingles(text: str) -> list[str]:
    words = template_words(text)
    return list(dict.fromkeys(" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)))


def size_classes(sizes: Iterable[int]) -> dict[int, tuple[int, int, int]]:
    """Window, stride and bands for templates of each number of shingles, so that a match is found with probability
    ``1 - MISS`` at least.

    Templates whose sizes differ by half at most are one class. A match holds ``CONTAINMENT`` of the shingles of a
    template of ``t`` shingles. Windows of ``largest + stride - 1`` shingles, a quarter of the largest apart, hold it
    whole, so window and template are at least as similar as ``needed / (window + t - needed)``. Each band is one MinHash
    value, equal with that probability.
    """
    classes: list[list[int]] = []
    for t in sorted(set(sizes)):
        if not classes or t > 1.5 * classes[-1][0]:
            classes.append([])
        classes[-1].append(t)
    out = {}
    for members in classes:
        stride = max(1, members[-1] // 4)
        window = members[-1] + stride - 1
        needed = {t: math.ceil(CONTAINMENT * t) for t in members}
        similar = min(n / (window + t - n) for t, n in needed.items())
        bands = 1 if similar >= 1 - MISS else math.ceil(math.log(MISS) / math.log(1 - similar))
        out |= {t: (window, stride, bands) for t in members}
    return out


def _rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small table of constants."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def template_table(spark: SparkSession, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """``license, text`` of a few named templates; longer lists are better kept as a table."""
    return _rows(spark, ["license", "text"], list(templates.items()))


def _words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, "[^a-z0-9]+"), lambda w: w != "")


def _word_shingles(words: str | Column, first: Column, last: Column) -> Column:
    return F.transform(F.sequence(first, last), lambda i: F.array_join(F.slice(words, i, SHINGLE), " "))


def _shingle_hash(word_hashes: Column, at: Column) -> Column:
    return F.xxhash64(F.slice(word_hashes, at, SHINGLE))


def _with_shingles(templates: DataFrame) -> tuple[DataFrame, list[int]]:
    """``license, template, shingles, n`` of the distinct templates, and the sizes that occur.

    Refuses templates without a name or five words, and more shingles than are to be broadcast.
    """
    rows = templates.select(templates["license"].cast("string").alias("license"), _words(templates["text"]).alias("words"))
    last = F.size("words") - SHINGLE + 1
    shingles = F.when(last >= 1, F.array_distinct(_word_shingles("words", F.lit(1), last)))
    rows = rows.select("license", F.coalesce(shingles, F.array().cast("array<string>")).alias("shingles")).distinct()
    rows = rows.select("license", F.xxhash64("license", "shingles").alias("template"), "shingles", F.size("shingles").alias("n"))
    sizes: list[int] = []
    total = 0
    per_size = rows.groupBy("n").agg(F.count("*").alias("templates"), F.count_if(F.col("license").isNull()).alias("unnamed"))
    for row in per_size.orderBy("n").collect():  # at most as many sizes as fit below MAX_SHINGLES, some 2,000
        total += row.n * row.templates
        if not row.n or row.unnamed:
            raise ValueError(f"a template needs a name and {SHINGLE} words")
        if total > MAX_SHINGLES:
            raise ValueError(f"templates have over {MAX_SHINGLES} shingles")
        sizes.append(row.n)
    return rows, sizes


def _bands(templates: DataFrame, sizes: list[int]) -> DataFrame:
    """``least, key, band, window, stride, template``: per template and band its MinHash value and the shingle that has it."""
    classes = _rows(templates.sparkSession, ["n", "window", "stride", "bands"], [(n, *c) for n, c in size_classes(sizes).items()])
    hashed = F.transform("shingles", lambda s: F.xxhash64(F.transform(F.split(s, " "), lambda w: F.xxhash64(w))))
    rows = templates.join(F.broadcast(classes), "n").select("template", "window", "stride", hashed.alias("s"), "bands")
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("bands") - 1)).alias("band"))
    values = F.transform("s", lambda h: F.struct(F.xxhash64(h, F.col("band")).alias("key"), h.alias("least")))
    return rows.select("template", "window", "stride", "band", F.array_min(values).alias("m")).select(
        "m.least", "m.key", "band", "window", "stride", "template"
    )


def _windows_around(at: Column) -> Column:
    """Starts (from 1) of the windows of the grid that hold the shingle at ``at``."""
    window, stride, n = F.col("window"), F.col("stride"), F.size("s")
    last = F.floor((F.greatest(n - window + stride, F.lit(1)) - 1) / stride)
    first = F.greatest(F.ceil((at - window) / stride), F.lit(0))
    most = F.least(F.floor((at - 1) / stride), last)
    steps = F.when(first <= most, F.sequence(first, most)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(steps, lambda k: (1 + k * stride).cast("int"))


def scan(
    docs: DataFrame, templates: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, license, containment, first_word``: templates of which a window of a text holds 0.8 of the shingles.

    ``templates`` has the columns license and text (default: ``TEMPLATES``); several texts may share a name, the best
    of them counts. Shingles are five words. Windows of a size for each class of templates lie a quarter of that size
    apart. A window has a template's MinHash value in a band only if it holds the one shingle with that value, so a text's
    shingles are looked up among those (a broadcast table of at most ``MAX_SHINGLES`` templates' shingles in all); the
    MinHash value is computed for the windows around what was found, and exact containment decides where it agrees.
    One row per id and license with the best containment and the first word of its window; texts stay in their row
    until a window has matched, so only matches are shuffled. Null, empty and shorter texts match nothing; matches in
    rows without an id have a null id, rows with the same id are reported together, other columns are ignored. A
    template table without rows finds nothing; templates without a name or five words are refused.
    """
    spark = docs.sparkSession
    table, sizes = _with_shingles(template_table(spark) if templates is None else templates)
    if not sizes:
        return spark.createDataFrame([], "doc_id bigint, license string, containment double, first_word bigint")
    bands = _bands(table, sizes)
    least = bands.agg(F.collect_set("least")).scalar()

    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), _words(docs[text_col]).alias("words"))
    rows = rows.select("doc_id", "words", F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    # Each array below is used at least twice in the next projection, so Spark computes it once and does not move it
    # into the function that runs per element.
    last = F.size("h") - SHINGLE + 1
    shingles = F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: _shingle_hash(F.col("h"), i)))
    rows = rows.select("doc_id", "words", shingles.alias("s"))
    # The task number is not deterministic, which keeps Spark from moving the filter, with all that it is computed
    # from, below the projections that compute each array once.
    rows = rows.select("doc_id", "words", "s", F.array_intersect("s", least).alias("hits"), F.spark_partition_id().alias("part"))
    rows = rows.where((F.size("hits") > 0) & (F.col("part") >= 0))
    found = rows.select("doc_id", "words", "s", F.explode("hits").alias("least")).join(F.broadcast(bands), "least")
    # Only windows with the template's MinHash value leave the row, each with its own words.
    places = F.filter(F.transform("s", lambda v, i: F.when(v == F.col("least"), i + 1)), lambda i: i.isNotNull())
    starts = F.array_distinct(F.flatten(F.transform(places, _windows_around)))
    value = lambda at: F.array_min(F.transform(F.slice("s", at, F.col("window")), lambda v: F.xxhash64(v, F.col("band"))))
    starts = F.filter(starts, lambda at: value(at) == F.col("key"))
    cut = F.transform(starts, lambda at: F.struct(at.alias("at"), F.slice("words", at, F.col("window") + SHINGLE - 1).alias("inside")))
    found = found.select("doc_id", "template", F.inline(cut)).join(F.broadcast(table), "template")
    inside = _word_shingles("inside", F.lit(1), F.size("inside") - SHINGLE + 1)
    share = F.size(F.array_intersect(F.col("shingles"), inside)) / F.col("n")
    exact = found.select("doc_id", "license", share.alias("containment"), (F.col("at") - 1).cast("bigint").alias("first_word"))
    best = F.max(F.struct("containment", (-F.col("first_word")).alias("back"))).alias("best")
    return exact.where(F.col("containment") >= CONTAINMENT).groupBy("doc_id", "license").agg(best).select(
        "doc_id", "license", "best.containment", (-F.col("best.back")).alias("first_word")
    )
