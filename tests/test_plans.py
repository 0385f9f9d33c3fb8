"""What must hold for a plan at any size: no table passes through one task, no cross joins, pruned scans."""

import re

import pytest

from qaloom.plans import catalog

SF = "/root/testdata/sf0.01"
# queries that write files while they are built are covered by the operators they use
WRITERS = {n for n in catalog.QUERIES if n.startswith(("sink_", "stream_", "stage_", "load_", "publish_"))} | {
    "questions_jsonl", "cache_jsonl", "runlog_text", "profile_stored"}


def plan_of(spark, name):
    return catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def nodes(plan):
    return [re.sub(r"^[\s:+\-*]*(\(\d+\)\s*)?", "", line) for line in plan.splitlines()]


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - WRITERS))
def test_single_task_stages_only_see_aggregates(spark, name):
    plan = nodes(plan_of(spark, name))
    assert not [n for n in plan if n.startswith(("CartesianProduct", "BroadcastNestedLoopJoin"))]
    for i, node in enumerate(plan):
        if node.startswith("Exchange SinglePartition"):
            below = next(n for n in plan[i + 1:] if not n.startswith(("Project", "Filter")))
            assert "Aggregate" in below.split("(")[0], below


def test_split_does_not_shuffle_the_texts(spark):
    plan = plan_of(spark, "split_rows")
    main = [line for line in plan.splitlines() if not line.startswith("   :")]
    assert not [line for line in main if "Exchange" in line]
    assert plan.count("ReadSchema: struct<doc_id:bigint,text:string>") == 1  # everything else reads ids only


def test_next_row_rereads_only_long_groups(spark):
    plan = plan_of(spark, "qa_pairs")
    assert "GreaterThanOrEqual(turn,4096)" in plan
    with_text = [s for s in re.findall(r"PushedFilters: (\[.*?\]), ReadSchema: (\S+)", plan) if "text:string" in s[1]]
    assert len([s for s in with_text if "turn,4096" not in s[0]]) == 1


def test_scores_need_no_shuffle_of_their_own(spark):
    pairs = nodes(plan_of(spark, "fmt_dpo_pairs"))
    scored = nodes(plan_of(spark, "pref_chrf"))
    count = lambda plan: len([n for n in plan if n.startswith("Exchange")])
    assert count(scored) <= count(pairs)
    assert len([n for n in scored if n.startswith("ArrowEvalPython")]) == 1
    f1 = nodes(plan_of(spark, "f1_char_loose"))
    assert len([n for n in f1 if n.startswith("ArrowEvalPython")]) == 1 and count(f1) <= count(pairs)
    assert not [n for n in scored + f1 if n.startswith("BatchEvalPython")]


def test_hot_pointers_of_both_sides_are_counted_once(spark):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = nodes(plan_of(spark, "pref_audit"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len([n for n in plan if n.startswith("HashAggregate(keys=[_bucket")]) == 2  # partial and final
    assert [n for n in plan if n.startswith("ReusedExchange [_bucket")]


def test_retained_checkpoints_are_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(spark, "run_keep_last2")


def test_status_of_questions_is_narrow(spark):
    """No exchange that decides which rows are kept carries a question text or a response."""
    run = catalog._run(spark, SF)
    assert set(run.status().columns) == {"id", "key", "response_key", "cached", "status"}
    assert set(catalog.QUERIES["tool_counters"](spark, SF).columns) == set(catalog.enrich.COUNTERS)
    plan = run.decide()._jdf.queryExecution().executedPlan().toString()
    assert "tool_response_json" not in plan and "SortAggregate" not in plan
    exchanged = nodes(plan)
    for i, node in enumerate(exchanged):
        if node.startswith("Exchange hashpartitioning(key#"):
            assert not re.search(r"\bquestion#", exchanged[i + 1].split("keys=")[-1]), exchanged[i + 1]


@pytest.mark.parametrize(("name", "wide"), [("first_seen_docs", "text"), ("question_unique", "question"), ("cache_latest", "response"), ("tool_rows", "response")])
def test_winners_are_found_on_narrow_rows(spark, name, wide):
    """Texts are never sorted by an aggregate and cross one exchange at most (here none: the winners are few enough)."""
    joins = ("spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    spark.conf.set(joins[0], "-1")
    try:
        plan = nodes(plan_of(spark, name))
    finally:
        spark.conf.set(*joins)
    assert not [n for n in plan if n.startswith("SortAggregate")]
    carried = []
    for i, node in enumerate(plan):
        if node.startswith("Exchange hashpartitioning"):
            below = next(n for n in plan[i + 1:] if n.startswith(("Project", "HashAggregate", "FileScan", "ColumnarToRow")))
            carried.append(bool(re.search(rf"[\[ ]{wide}#\d+[,\]]|AS {wide}#", below)))
    assert sum(carried) <= 1, plan


@pytest.mark.parametrize("name", ["split_rows", "split_counts", "shuffle_limit_docs", "global_rank_docs", "sample_cap_docs", "profile_rollup"])
def test_rows_are_computed_twice_at_most(spark, name):
    """Once for the stored position index, once for the result."""
    assert plan_of(spark, name).count(f"{SF}/documents.parquet") == 1
