"""Question generation: topic items x the templates of their category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.operators.dedupe import first_seen, packed
from qaloom.operators.order import global_rank
from qaloom.operators.splits import shuffle_limit
from qaloom.schemas import require_columns

SLOT = "{x}"


def expand_templates(items: DataFrame, templates: dict[str, list[str]]) -> DataFrame:
    """One row per (item, template of the item's category).

    ``items``: category, item_ord, item. Templates are job parameters, as in ``templates`` given
    category -> list in order, so each item generates its own rows: no join and no shuffle, and a
    category with most of the items stays spread over its input partitions.
    """
    require_columns(items, "category", "item_ord", "item")
    lists = F.create_map(*[
        x for category, texts in templates.items() for x in (F.lit(category), F.array(*[F.lit(t) for t in texts]))
    ])
    ranks = F.create_map(*[x for i, category in enumerate(templates) for x in (F.lit(category), F.lit(i))])
    return (
        items.where(F.col("category").isin(*templates))
        .withColumn("cat_ord", F.element_at(ranks, F.col("category")))
        .select("category", "cat_ord", "item_ord", "item", F.posexplode(F.element_at(lists, F.col("category"))))
        .withColumnsRenamed({"pos": "template_ord", "col": "template"})
        .withColumn("question", F.replace("template", F.lit(SLOT), F.col("item")))
    )


def union_categories(parts: dict[str, DataFrame]) -> DataFrame:
    """Concatenates per-category tables; ``cat_ord`` keeps the category order."""
    out = None
    for i, (category, df) in enumerate(parts.items()):
        part = df.withColumns({"category": F.lit(category), "cat_ord": F.lit(i)})
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no categories given")
    return out


def generation_order() -> Column:
    """Category order, then item order, then template order, as one number."""
    return packed(("cat_ord", 31), ("item_ord", 64), ("template_ord", 31))


def unique_questions(grid: DataFrame) -> DataFrame:
    """First occurrence of every question in generation order."""
    return first_seen(grid, "question", generation_order())


def sample_questions(grid: DataFrame, limit: int | None, seed: int = 42) -> DataFrame:
    """Distinct questions with their rank in seeded order, cut at ``limit`` if given; the question itself is the id."""
    distinct = grid.select("question").distinct()
    return global_rank(distinct, "question", seed) if limit is None else shuffle_limit(distinct, "question", limit, seed)


def category_counts(items: DataFrame, templates: dict[str, list[str]]) -> DataFrame:
    """Items, templates and their product per category, and a total row (category null)."""
    n_templates = F.create_map(*[x for c, texts in templates.items() for x in (F.lit(c), F.lit(len(texts)))])
    per_category = (
        items.where(F.col("category").isin(*templates))
        .groupBy("category")
        .agg(F.count("*").alias("n_items"))
        .withColumn("n_templates", F.element_at(n_templates, F.col("category")).cast("bigint"))
        .withColumn("n_questions", F.col("n_items") * F.col("n_templates"))
    )
    return per_category.rollup("category").agg(*[
        F.sum(c).alias(c) for c in ("n_items", "n_templates", "n_questions")
    ])
