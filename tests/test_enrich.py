import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from qaloom import schemas
from qaloom.operators import enrich

NOTHING = {"answer": "", "results": []}


def seeded(rows, seed=42):
    return sorted(rows, key=lambda r: (hashlib.md5(f"{seed}|{r[0]}".encode()).hexdigest(), r[0]))


def expectation(rows, cache, limit, factor, require_answer):
    """Outcome of every usable row, cut behind the ``limit``-th kept one."""
    pool = seeded(rows) if limit is None else seeded(rows)[:limit * factor]
    usable = [(i, (q or "").strip(), (a or "").strip()) for i, q, a in pool]
    usable = [(i, q, a) for i, q, a in usable if q and (a or not require_answer)]
    owner = {q: i for i, q, _ in reversed(usable)}
    outcomes = []
    for i, q, a in usable:
        response = cache.get(q, NOTHING)
        found = response["results"] or [{"content": ""}]
        text = a or (response["answer"] or "").strip() or found[0]["content"].strip()
        good = bool(response["results"]) and text != ""
        outcomes.append(("dupe" if owner[q] != i else "kept" if good else "empty", q in cache, (i, q, text)))
    ends = [n + 1 for n, (what, *_) in enumerate(outcomes) if what == "kept"]
    if limit is not None and limit <= len(ends):
        outcomes = outcomes[:ends[limit - 1] if limit else 0]
    what = [o[0] for o in outcomes]
    hits = [cached for w, cached, _ in outcomes if w != "dupe"]
    tally = {"kept": what.count("kept"), "cache_hits": sum(hits), "api_calls": len(hits) - sum(hits),
             "skipped_empty": what.count("empty"), "skipped_dupe": what.count("dupe")}
    return tally, {i: (q, text) for w, _, (i, q, text) in outcomes if w == "kept"}


def frames(spark, rows, cache):
    questions = spark.createDataFrame(rows, "id long, question string, answer string").repartition(3)
    entries = [(q, (r["answer"], r["results"])) for q, r in cache.items()]
    return questions, spark.createDataFrame(entries, schemas.CACHE).repartition(2)


def sample(seed, n=12, hot=False):
    rng = random.Random(seed)
    texts = ["", " \t", "same", " same ", "miss", "empty", "no content", "own", "derive", "nulls"] + [f"q{i}" for i in range(n // 2)]
    weights = [8 if hot and t == "same" else 1 for t in texts]
    rows = [(i, rng.choices(texts, weights)[0] if rng.random() > 0.05 else None, rng.choice(["", "ans", "  ans ", None]))
            for i in range(n)]
    found = [{"title": "t", "url": "u", "content": " body "}]
    cache = {"same": {"answer": " short ", "results": found}, "empty": {"answer": "x", "results": []},
             "no content": {"answer": "", "results": [{"title": "t", "url": "", "content": "  "}]},
             "own": {"answer": "own answer", "results": found}, "derive": {"answer": "", "results": found},
             "nulls": {"answer": None, "results": None}}
    cache.update({f"q{i}": {"answer": "", "results": found} for i in range(0, n // 2, 2)})
    return rows, cache


@pytest.mark.parametrize("limit", [0, 3, 99, None])
@pytest.mark.parametrize("require_answer", [True, False])
def test_rows_and_counters(spark, limit, require_answer):
    rows, cache = sample(limit or 7, n=60, hot=True)
    tally, kept = expectation(rows, cache, limit, 2, require_answer)
    got, counters = enrich.enrich(*frames(spark, rows, cache), limit=limit, oversample=2, require_answer=require_answer)
    assert counters.collect()[0].asDict() == tally
    assert {r.id: (r.question, r.answer) for r in got.collect()} == kept


@pytest.mark.parametrize("limit", [0, 3, None])
def test_work_list_is_what_the_counters_count(spark, limit):
    rows, cache = sample(3, n=60)
    run = enrich.Enrichment(*frames(spark, rows, cache), limit=limit, oversample=4, require_answer=False).prepare()
    listed = [r.question for r in run.missing().collect()]
    assert len(listed) == len(set(listed)) == run.counters().collect()[0].api_calls
    assert not set(listed) & set(cache)


def test_a_log_is_reduced_to_its_last_writes(spark, tmp_path):
    rows, cache = sample(5, n=60)
    questions, latest = frames(spark, rows, cache)
    number = F.crc32(F.col("query"))
    old = latest.select("query", F.lit(None).cast(latest.schema["response"].dataType).alias("response"), (-1 - number).alias("at"))
    log = latest.withColumn("at", number).unionByName(old)
    plain = enrich.Enrichment(questions, latest, limit=9, oversample=4).prepare()
    run = enrich.Enrichment(questions, log, limit=9, oversample=4, order="at", scratch=str(tmp_path)).prepare()
    assert run.counters().collect() == plain.counters().collect()
    assert sorted(map(str, run.rows().collect())) == sorted(map(str, plain.rows().collect()))
    assert len(list(tmp_path.iterdir())) == 1
    run.release()
    assert not list(tmp_path.iterdir())
    with pytest.raises(RuntimeError, match="prepare"):
        run.rows()


def test_a_later_copy_does_not_rescue_a_failed_question(spark):
    rows = [(i, "empty", "a") for i in range(5)]
    _, counters = enrich.enrich(*frames(spark, rows, {"empty": {"answer": "x", "results": []}}))
    assert counters.collect()[0].asDict() == {"kept": 0, "cache_hits": 1, "api_calls": 0, "skipped_empty": 1, "skipped_dupe": 4}


def test_response_text_and_sources(spark):
    long = "x" * 601
    results = [{"title": None, "url": "u1", "content": " a\nb "}, {"title": "T", "url": "", "content": long},
               {"title": "T3", "url": "u3", "content": None}, {"title": "T4", "url": "u4", "content": "cut off"}]
    df = spark.createDataFrame([(1, (None, results))], "id int, response struct<answer:string,results:array<struct<title:string,url:string,content:string>>>")
    text = df.select(enrich.tool_response_json(F.col("response")).alias("j")).collect()[0].j
    want = [{"title": "", "url": "u1", "content": "a b"}, {"title": "T", "url": "", "content": "x" * 600 + "..."},
            {"title": "T3", "url": "u3", "content": ""}]
    assert text == json.dumps(want, ensure_ascii=False)
    assert [tuple(r) for r in enrich.sources_list(df, "id").orderBy("pos").collect()] == [(1, 0, "u1", "u1"), (1, 2, "T3", "u3")]


def test_derived_answer(spark):
    first = [{"title": "", "url": "", "content": " one\ntwo "}]
    cases = [(" given ", first, "given"), ("y" * 500, first, "y" * 400), ("z" * 399 + " q", None, "z" * 399),
             ("  ", first, "one two"), (None, [], ""), (None, None, ""), ("", [{"title": "", "url": "", "content": None}], "")]
    df = spark.createDataFrame([(i, (a, r)) for i, (a, r, _) in enumerate(cases)],
                               "i int, response struct<answer:string,results:array<struct<title:string,url:string,content:string>>>")
    got = df.select("i", enrich.derived_answer(F.col("response")).alias("a")).orderBy("i").collect()
    assert [r.a for r in got] == [want for *_, want in cases]


def test_work_list_and_hits(spark):
    rows = [(1, " a ", ""), (2, "a", ""), (3, "b", ""), (4, "", ""), (5, None, "")]
    questions, cache = frames(spark, rows, {"a": NOTHING})
    assert [r.question for r in enrich.missing_queries(questions, cache).collect()] == ["b"]
    assert [r.question for r in enrich.cache_hits(questions, cache).collect()] == ["a"]
    joined = {r.id: r.response is not None for r in enrich.join_cache(questions, cache, "id").collect()}
    assert joined == {1: True, 2: True, 3: False, 4: False, 5: False}
