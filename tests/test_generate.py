from qaloom.operators import generate

TEMPLATES = {"b": ["{x}?", "Who is {x}?"], "a": ["{x}?", "{x} {x}"]}


def items(spark):
    rows = [("a", 1, "one"), ("a", 2, "two"), ("b", 1, "two"), ("b", 2, "one"), ("none", 1, "zzz")]
    return spark.createDataFrame(rows, "category string, item_ord int, item string").repartition(3)


def test_grid_follows_category_item_template_order(spark):
    grid = generate.expand_templates(items(spark), TEMPLATES)
    got = [r.question for r in grid.orderBy("cat_ord", "item_ord", "template_ord").collect()]
    assert got == ["two?", "Who is two?", "one?", "Who is one?", "one?", "one one", "two?", "two two"]


def test_first_occurrence_wins(spark):
    unique = generate.unique_questions(generate.expand_templates(items(spark), TEMPLATES))
    assert {(r.question, r.category) for r in unique.collect()} == {
        ("two?", "b"), ("Who is two?", "b"), ("one?", "b"), ("Who is one?", "b"), ("one one", "a"), ("two two", "a"),
    }


def test_sample_is_distinct_and_seeded(spark):
    grid = generate.expand_templates(items(spark), TEMPLATES)
    sample = [r.question for r in generate.sample_questions(grid, 4).orderBy("rank").collect()]
    assert len(set(sample)) == 4
    assert sample == [r.question for r in generate.sample_questions(grid.repartition(5), 4).orderBy("rank").collect()]
    assert generate.sample_questions(grid, 100).count() == 6


def test_counts_and_union(spark):
    rows = {r.category: (r.n_items, r.n_templates, r.n_questions) for r in generate.category_counts(items(spark), TEMPLATES).collect()}
    assert rows == {"a": (2, 2, 4), "b": (2, 2, 4), None: (4, 4, 8)}
    union = generate.union_categories({"x": spark.range(2), "y": spark.range(3)})
    assert {(r.category, r.cat_ord): r["count"] for r in union.groupBy("category", "cat_ord").count().collect()} == {("x", 0): 2, ("y", 1): 3}
