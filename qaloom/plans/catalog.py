"""Registered queries: name -> (spark, folder) -> DataFrame, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.functions.text import normalise_strict, words
from qaloom.functions.tokenizing import split_tokenizer, tokenizer_count
from qaloom.functions.overlap import char_bag_overlap
from qaloom.operators import batches, dedupe, enrich, filters, formats, generate, joins, order, prefs, profiling, runlogs, scoring
from qaloom.operators import splits, toolcalls
from qaloom.plans import inputs as I
from qaloom.plans import jobs
from qaloom.session import scratch_dir
from qaloom.sources import readers, writers
from qaloom.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes) + "\n"


def _rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


WS_SQL = r"E' \t\n\r'"
TOKENS_SQL = "len(list_filter(string_split_regex({0}, '[ \\t\\n\\r]+'), lambda x: x <> ''))"
SYSTEM_SQL = f"concat('<|im_start|>system\n{formats.SYSTEM_MESSAGE}\n<tools>\n{formats.TOOLS_JSON}\n</tools><|im_end|>\n')"
USER_SQL = "concat('<|im_start|>user\n', {0}, '<|im_end|>\n<|im_start|>assistant\n')"
CALL_SQL = """concat('{{"name": "web_search", "arguments": {{"query": ', CAST(to_json({0}) AS VARCHAR), '}}}}')"""

# ------------------------------------------------------------------------------ formats and prompts


@query("SELECT doc_id, concat(text, '<|endoftext|>') AS text FROM documents")
def fmt_text_docs(spark, sf):
    return I.table(spark, sf, "documents").select("doc_id", "text").transform(formats.fmt_text)


@query(_with(I.QA_SQL) + "SELECT * FROM qa")
def qa_pairs(spark, sf):
    return I.qa(spark, sf)


@query(_with(I.QA_SQL) + f"SELECT qa_id, concat({USER_SQL.format('question')}, answer, '<|im_end|>') AS text FROM qa")
def fmt_qa_pairs(spark, sf):
    return formats.fmt_qa(I.qa(spark, sf)).select("qa_id", "text")


@query(_with(I.PREF_SQL) + f"""SELECT qa_id, {USER_SQL.format('prompt')} AS prompt,
  concat(chosen, '<|im_end|>') AS chosen, concat(rejected, '<|im_end|>') AS rejected FROM pref""")
def fmt_dpo_pairs(spark, sf):
    return formats.fmt_dpo(I.pref(spark, sf)).select("qa_id", "prompt", "chosen", "rejected")


@query(_with(I.QA_SQL) + f"SELECT qa_id, {USER_SQL.format('question')} AS prompt FROM qa")
def prompt_generate(spark, sf):
    return formats.prompt_generate(I.qa(spark, sf)).select("qa_id", "prompt")


@query(_with(I.QA_SQL) + f"SELECT qa_id, concat({SYSTEM_SQL}, {USER_SQL.format('question')}) AS prompt FROM qa")
def prompt_round1(spark, sf):
    return formats.prompt_round1(I.qa(spark, sf)).select("qa_id", "prompt")


@query(_with(I.MODEL_OUT_SQL) + f"""
SELECT qa_id, concat({SYSTEM_SQL}, {USER_SQL.format('question')},
  '<tool_call>{{"name": "web_search", "arguments": {{"query": "q', qa_id, '"}}}}</tool_call><|im_end|>
<|im_start|>tool
<tool_response>[{{"title": "", "url": "", "content": ',
  CAST(to_json(CASE WHEN length(replace(trim(answer, {WS_SQL}), chr(10), ' ')) > 600
    THEN concat(rtrim(substring(replace(trim(answer, {WS_SQL}), chr(10), ' '), 1, 600), {WS_SQL}), '...')
    ELSE replace(trim(answer, {WS_SQL}), chr(10), ' ') END) AS VARCHAR),
  '}}]</tool_response><|im_end|>
<|im_start|>assistant
') AS prompt FROM model_out WHERE output LIKE 'x <tool_call>%'""")
def prompt_round2(spark, sf):
    calls = toolcalls.tool_call_check(I.model_out(spark, sf)).where("status = 'ok'")
    first = formats.prompt_round1(calls).select("qa_id", "prompt", F.col("raw_call").alias("tool_call"))
    result = F.struct(F.lit(None).cast("string").alias("title"), F.lit("").alias("url"), F.col("answer").alias("content"))
    response = F.struct(F.lit("").alias("answer"), F.array(result).alias("results"))
    responses = I.qa(spark, sf).select("qa_id", enrich.tool_response_json(response).alias("tool_response_json"))
    return formats.prompt_round2(first.join(responses, "qa_id")).select("qa_id", "prompt")


@query(_with(I.QA_SQL) + f"SELECT qa_id, {USER_SQL.format('question')} AS prompt, trim(answer, {WS_SQL}) AS answer FROM qa")
def prompt_and_answer_recover(spark, sf):
    text = F.col("text")
    return formats.fmt_qa(I.qa(spark, sf)).select(
        "qa_id", formats.prompt_recover(text).alias("prompt"),
        formats.answer_cut(formats.answer_recover(text)).alias("answer"),
    )


@query(_with(I.MODEL_OUT_SQL) + f"SELECT qa_id, trim(string_split(output, '<|im_end|>')[1], {WS_SQL}) AS answer FROM model_out")
def answer_cut(spark, sf):
    return I.model_out(spark, sf).select("qa_id", formats.answer_cut(F.col("output")).alias("answer"))


@query("SELECT doc_id, CASE WHEN length(text) < 200 THEN text ELSE concat(substring(text, 1, 200), '...') END AS text FROM documents")
def preview_docs(spark, sf):
    return formats.preview_columns(I.table(spark, sf, "documents").select("doc_id", "text"), "text")


@query(f"SELECT doc_id, '{formats.TOOLS_JSON}' AS tools_json, {CALL_SQL.format('text')} AS tool_call_json FROM documents")
def tool_call_build(spark, sf):
    return I.table(spark, sf, "documents").select(
        "doc_id", F.lit(formats.TOOLS_JSON).alias("tools_json"), formats.tool_call_json(F.col("text")).alias("tool_call_json")
    )


# ------------------------------------------------------------------------------ splits and samples

ORDER_SQL = "md5(concat('42|', CAST({0} AS VARCHAR))), {0}"
RANKED_DOCS = f"ranked AS (SELECT *, row_number() OVER (ORDER BY {ORDER_SQL.format('doc_id')}) AS rn FROM documents)"
RANKED_QA = I.QA_SQL + f""", ranked AS (
  SELECT *, row_number() OVER (ORDER BY {ORDER_SQL.format('qa_id')}) AS rn, count(*) OVER () AS n FROM qa),
quarters AS (
  SELECT *, CASE WHEN rn <= ceil(ceil(n * 0.25) * 0.25) THEN 'validation' WHEN rn <= ceil(n * 0.25) THEN 'test'
            ELSE 'train' END AS split FROM ranked)"""
SPLIT_SQL = "CASE WHEN rn <= 50 THEN 'validation' WHEN rn <= 100 THEN 'test' ELSE 'train' END"


@query(_with(RANKED_DOCS) + f"SELECT doc_id, text, {SPLIT_SQL} AS split FROM ranked")
def split_rows(spark, sf):
    docs = I.table(spark, sf, "documents").select("doc_id", "text")
    return splits.split_exact(docs, "doc_id", test=100, validation=50)


@query(_with(RANKED_DOCS) + f"SELECT {SPLIT_SQL} AS split, count(*) AS n_rows FROM ranked GROUP BY 1")
def split_counts(spark, sf):
    docs = I.table(spark, sf, "documents").select("doc_id")
    return splits.split_counts(splits.split_exact(docs, "doc_id", test=100, validation=50))


@query(_with(RANKED_QA) + "SELECT qa_id, split FROM quarters")
def split_default_quarter(spark, sf):
    return splits.split_exact(I.qa(spark, sf), "qa_id").select("qa_id", "split")


@query(_with(RANKED_DOCS) + f""",
sizes AS (SELECT {SPLIT_SQL} AS split, count(*) AS n_rows FROM ranked GROUP BY 1),
declared(split, declared_rows) AS (VALUES ('train', 900), ('validation', 50), ('test', 100))
SELECT split, CAST(declared_rows AS BIGINT) AS declared_rows, n_rows, CAST(0 AS BIGINT) AS ids_in_several_splits,
       declared_rows = n_rows AS sizes_agree FROM declared JOIN sizes USING (split)""")
def split_verify(spark, sf):
    docs = I.table(spark, sf, "documents").select("doc_id")
    split = splits.split_exact(docs, "doc_id", test=100, validation=50)
    return splits.split_verify(split, "doc_id", {"train": 900, "validation": 50, "test": 100})


@query(_with(RANKED_QA) + "SELECT split, count(*) AS n_rows FROM quarters GROUP BY 1")
def split_passthrough(spark, sf):
    return splits.split_counts(splits.split_table(split_default_quarter(spark, sf), "qa_id"))


@query(_with(RANKED_DOCS) + "SELECT doc_id, text FROM ranked WHERE rn > 50")
def union_two_splits(spark, sf):
    split = split_rows(spark, sf)
    parts = {s: split.where(F.col("split") == s).drop("split") for s in splits.SPLITS}
    return splits.union_splits(parts, ["train", "test"])


@query("SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 5")
def sample_head5(spark, sf):
    docs = I.table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return splits.sample_head(docs, "doc_id", 5, drop=("text",))


@query(_with(RANKED_DOCS) + "SELECT doc_id, text, rn AS rank FROM ranked WHERE rn <= 150")
def shuffle_limit_docs(spark, sf):
    return splits.shuffle_limit(I.table(spark, sf, "documents").select("doc_id", "text"), "doc_id", 150)


@query(_with(RANKED_DOCS) + "SELECT doc_id, rn AS rank FROM ranked")
def global_rank_docs(spark, sf):
    return order.global_rank(I.table(spark, sf, "documents").select("doc_id"), "doc_id")


@query(f"""SELECT doc_id, lang FROM documents
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {ORDER_SQL.format('doc_id')}) <= 100""")
def sample_cap_docs(spark, sf):
    return splits.sample_cap(I.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 100, by=("lang",))


# ------------------------------------------------------------------------------ question generation


@query(_with(I.GRID_SQL) + "SELECT * FROM grid")
def question_grid(spark, sf):
    return generate.expand_templates(I.topic_items(spark, sf), I.TEMPLATES)


@query(_with(I.GRID_SQL) + """SELECT category, count(DISTINCT item_ord) AS n_items, count(DISTINCT template_ord) AS n_templates,
  count(*) AS n_questions FROM grid GROUP BY category
UNION ALL SELECT NULL, count(DISTINCT item_ord), (SELECT count(*) FROM templates), count(*) FROM grid""")
def question_counts(spark, sf):
    return generate.category_counts(I.topic_items(spark, sf), I.TEMPLATES).withColumns(
        {c: F.col(c).cast("bigint") for c in ("n_items", "n_templates", "n_questions")}
    )


@query(_with(I.GRID_SQL) + """SELECT * FROM grid
QUALIFY row_number() OVER (PARTITION BY question ORDER BY cat_ord, item_ord, template_ord) = 1""")
def question_unique(spark, sf):
    return generate.unique_questions(question_grid(spark, sf))


@query(_with(I.GRID_SQL) + """SELECT question, row_number() OVER (ORDER BY md5(concat('42|', question)), question) AS rank
FROM (SELECT DISTINCT question FROM grid) d QUALIFY rank <= 100""")
def question_sample(spark, sf):
    return generate.sample_questions(question_grid(spark, sf), 100)


@query(_with(I.GRID_SQL) + """SELECT cat_ord, count(*) AS n_rows FROM
  (SELECT DISTINCT cat_ord, question FROM grid) GROUP BY 1""")
def union_categories(spark, sf):
    items = I.topic_items(spark, sf)
    parts = {
        c: generate.expand_templates(items.where(F.col("category") == c), {c: texts}).select("question")
        for c, texts in I.TEMPLATES.items()
    }
    union = generate.union_categories(parts).select("cat_ord", "question")
    return dedupe.distinct_rows(union).groupBy("cat_ord").agg(F.count("*").alias("n_rows"))


@query("SELECT doc_id, text FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def first_seen_docs(spark, sf):
    return dedupe.first_seen(I.table(spark, sf, "documents").select("doc_id", "text"), "text", F.col("doc_id"))


@query("SELECT DISTINCT text, lang FROM documents")
def dedupe_exact_docs(spark, sf):
    return dedupe.distinct_rows(I.table(spark, sf, "documents").select("text", "lang"))


# ------------------------------------------------------------------------------ cache and enrichment

CACHE_ROW = "query, answer, len(results) AS n_results"


def _flat(cache: DataFrame) -> DataFrame:
    return cache.select(
        "query", F.col("response.answer").alias("answer"), F.size("response.results").cast("bigint").alias("n_results")
    )


@query(_with(I.CACHE_SQL) + f"SELECT {CACHE_ROW} FROM cache")
def cache_latest(spark, sf):
    return _flat(I.cache(spark, sf))


@query(_with(I.SEED_SQL) + f"SELECT id, answer FROM seed WHERE trim(question, {WS_SQL}) <> '' AND trim(answer, {WS_SQL}) <> ''")
def flt_blank(spark, sf):
    seed = I.seed_questions(spark, sf).transform(filters.flt_blank_question).transform(filters.flt_blank_answer)
    return seed.select("id", "answer")


@query(_with(I.CACHE_SQL) + f"SELECT {CACHE_ROW} FROM cache WHERE len(results) > 0")
def flt_no_result(spark, sf):
    return _flat(filters.flt_no_result(I.cache(spark, sf)))


SEED_CACHE = _with(I.SEED_SQL, I.CACHE_SQL)


@query(SEED_CACHE + f"""SELECT s.id, query IS NOT NULL AS cached, c.answer, len(results) AS n_results
FROM seed s LEFT JOIN cache c ON trim(s.question, {WS_SQL}) = c.query""")
def join_cache(spark, sf):
    joined = enrich.join_cache(I.seed_questions(spark, sf).select("id", "question"), I.cache(spark, sf), "id")
    return joined.select(
        "id", F.col("response").isNotNull().alias("cached"), F.col("response.answer").alias("answer"),
        F.when(F.col("response").isNotNull(), F.size("response.results")).cast("bigint").alias("n_results"),
    )


@query(SEED_CACHE + f"""SELECT DISTINCT trim(question, {WS_SQL}) AS question FROM seed
WHERE trim(question, {WS_SQL}) IN (SELECT query FROM cache)""")
def cache_hits(spark, sf):
    return enrich.cache_hits(I.seed_questions(spark, sf), I.cache(spark, sf))


@query(SEED_CACHE + f"""SELECT DISTINCT trim(question, {WS_SQL}) AS question FROM seed
WHERE trim(question, {WS_SQL}) NOT IN (SELECT query FROM cache)""")
def cache_missing(spark, sf):
    return enrich.missing_queries(I.seed_questions(spark, sf), I.cache(spark, sf))


@query(_with(I.CACHE_SQL) + "SELECT query, derived AS answer, tool_response_json FROM responses")
def response_texts(spark, sf):
    response = F.col("response")
    return I.cache(spark, sf).select(
        "query", enrich.derived_answer(response).alias("answer"), enrich.tool_response_json(response).alias("tool_response_json")
    )


@query(_with(I.CACHE_SQL) + """SELECT seq, CAST(i - 1 AS INTEGER) AS pos, results[i].title AS title, results[i].url AS url
FROM cache, (SELECT unnest([1, 2, 3]) AS i) p WHERE i <= len(results) AND results[i].url <> ''""")
def tool_sources(spark, sf):
    return enrich.sources_list(dedupe.last_written(I.response_log(spark, sf), "query", F.col("seq")), "seq")


def _walk_sql(require_answer: bool, limit: int | None, oversample: int) -> str:
    """Plain-SQL replay of the row-by-row job: candidates, first-seen, usable, running count."""
    candidates = "" if limit is None else f"QUALIFY row_number() OVER (ORDER BY {ORDER_SQL.format('id')}) <= {limit * oversample}"
    stop = "true" if limit is None else f"n_before < {limit}"
    blank = "AND answer <> ''" if require_answer else ""
    return SEED_CACHE.rstrip() + f""",
candidates AS (SELECT * FROM seed {candidates}),
usable AS (SELECT id, trim(question, {WS_SQL}) AS question, trim(answer) AS answer FROM candidates
           WHERE trim(question, {WS_SQL}) <> '' {blank}),
firsts AS (SELECT *, row_number() OVER (PARTITION BY question ORDER BY {ORDER_SQL.format('id')}) = 1 AS is_first FROM usable),
judged AS (
  SELECT f.id, f.question, f.is_first, r.query IS NOT NULL AS cached, r.tool_response_json,
         CASE WHEN f.answer <> '' THEN f.answer ELSE r.derived END AS final_answer,
         f.is_first AND r.query IS NOT NULL AND len(r.results) > 0 AND (f.answer <> '' OR r.derived <> '') AS productive
  FROM firsts f LEFT JOIN responses r ON f.question = r.query),
walked AS (SELECT *, coalesce(sum(CAST(productive AS INTEGER)) OVER (ORDER BY {ORDER_SQL.format('id')}
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_before FROM judged),
visited AS (SELECT * FROM walked WHERE {stop})
"""


ROWS_SQL = f"""SELECT id, '{formats.TOOLS_JSON}' AS tools_json, question, {CALL_SQL.format('question')} AS tool_call_json,
  tool_response_json, final_answer AS answer FROM visited WHERE productive"""
COUNTERS_SQL = """SELECT count(*) FILTER (WHERE productive) AS kept, count(*) FILTER (WHERE is_first AND cached) AS cache_hits,
  count(*) FILTER (WHERE is_first AND NOT cached) AS api_calls, count(*) FILTER (WHERE is_first AND NOT productive) AS skipped_empty,
  count(*) FILTER (WHERE NOT is_first) AS skipped_dupe FROM visited"""
LIMITED = {"limit": 300, "oversample": 4}


def _run(spark, sf, **options) -> enrich.Enrichment:
    return enrich.Enrichment(I.seed_questions(spark, sf), I.response_log(spark, sf), order="seq", **options).prepare()


@query(_walk_sql(True, None, 1) + ROWS_SQL)
def tool_rows(spark, sf):
    return _run(spark, sf).rows()


@query(_walk_sql(False, None, 1) + ROWS_SQL)
def tool_rows_derived(spark, sf):
    return _run(spark, sf, require_answer=False).rows()


@query(_walk_sql(False, 300, 4) + ROWS_SQL)
def tool_rows_early_stop(spark, sf):
    return _run(spark, sf, require_answer=False, **LIMITED).rows()


@query(_walk_sql(True, None, 1) + COUNTERS_SQL)
def tool_counters(spark, sf):
    return _run(spark, sf).counters()


@query(_walk_sql(False, 300, 4) + COUNTERS_SQL)
def tool_counters_early_stop(spark, sf):
    return _run(spark, sf, require_answer=False, **LIMITED).counters()


@query(_walk_sql(True, None, 1) + f"""SELECT id, concat({SYSTEM_SQL}, '<|im_start|>user
', question, '<|im_end|>
<|im_start|>assistant
<tool_call>', {CALL_SQL.format('question')}, '</tool_call><|im_end|>
<|im_start|>tool
<tool_response>', tool_response_json, '</tool_response><|im_end|>
<|im_start|>assistant
', final_answer, '<|im_end|>') AS text FROM visited WHERE productive""")
def fmt_tool_dialog(spark, sf):
    return formats.fmt_tool_dialog(tool_rows(spark, sf)).select("id", "text")


# ------------------------------------------------------------------------------ tool calls

CHECKED_SQL = I.MODEL_OUT_SQL + """,
found AS (SELECT qa_id, turn, regexp_extract(output, '(?s)<tool_call>\\s*(\\{.+?\\})\\s*</tool_call>', 1) AS body FROM model_out),
checked AS (SELECT qa_id, turn, CASE WHEN body = '' THEN 'none' WHEN NOT json_valid(body) THEN 'bad_json'
  WHEN json_extract_string(body, '$.arguments.query') IS NULL THEN 'no_query' ELSE 'ok' END AS status,
  CASE WHEN json_valid(body) THEN json_extract_string(body, '$.arguments.query') END AS query FROM found)"""


@query(_with(CHECKED_SQL) + "SELECT qa_id, status, query FROM checked")
def tool_call_status(spark, sf):
    return toolcalls.tool_call_check(I.model_out(spark, sf)).select("qa_id", "status", "query")


@query(_with(CHECKED_SQL) + "SELECT turn, status, count(*) AS n_rows FROM checked GROUP BY ALL")
def tool_call_counts(spark, sf):
    return toolcalls.tool_call_counts(toolcalls.tool_call_check(I.model_out(spark, sf)), "turn")


# ------------------------------------------------------------------------------ preference pairs

SCORES_SQL = I.PREF_SQL + """,
cosines AS (
  SELECT p.*, list_dot_product(CAST(c.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])) AS cosine
  FROM pref p JOIN embeddings c ON c.vec_id = p.chosen_vec_id JOIN embeddings r ON r.vec_id = p.rejected_vec_id),
squeezed AS (
  SELECT qa_id, regexp_replace(rejected, '[ \\t\\n\\r]+', '', 'g') AS h, regexp_replace(chosen, '[ \\t\\n\\r]+', '', 'g') AS r FROM pref),
starts AS (
  SELECT qa_id, side, n, t, unnest(range(1, length(t) - n + 2)) AS i FROM (
    SELECT qa_id, 'h' AS side, h AS t FROM squeezed UNION ALL SELECT qa_id, 'r', r FROM squeezed) s,
    (SELECT unnest([1, 2, 3, 4, 5, 6]) AS n) o),
grams AS (SELECT qa_id, n, substring(t, i, n) AS gram, count(*) FILTER (WHERE side = 'h') AS nh, count(*) FILTER (WHERE side = 'r') AS nr
          FROM starts GROUP BY ALL),
per_order AS (SELECT qa_id, n, sum(least(nh, nr)) AS m, sum(nh) AS nh, sum(nr) AS nr FROM grams GROUP BY ALL),
means AS (SELECT qa_id, avg(m / nh) AS p, avg(m / nr) AS r FROM per_order WHERE nh > 0 AND nr > 0 GROUP BY qa_id),
chrfs AS (SELECT s.qa_id, CASE WHEN coalesce(p + m.r, 0) > 0 THEN 5 * p * m.r / (4 * p + m.r) ELSE 0 END AS chrf
          FROM squeezed s LEFT JOIN means m USING (qa_id)),
audit AS (
  SELECT *, NOT score >= 0.85 AS kept, CASE WHEN score >= 0.85 THEN 'too_similar (score>=0.85)' END AS drop_reason
  FROM (SELECT c.*, chrf, 0.7 * cosine + 0.3 * chrf AS score FROM cosines c JOIN chrfs USING (qa_id)) x)"""


@query(_with(SCORES_SQL) + "SELECT qa_id, round(cosine, 6) AS cosine FROM cosines")
def pref_cosine(spark, sf):
    return _rounded(prefs.cosine(I.pref_with_vectors(spark, sf)).select("qa_id", "cosine"), "cosine")


@query(_with(SCORES_SQL) + "SELECT qa_id, round(chrf, 6) AS chrf FROM chrfs")
def pref_chrf(spark, sf):
    return _rounded(prefs.chrf(I.pref(spark, sf)).select("qa_id", "chrf"), "chrf")


def _audit(spark, sf) -> DataFrame:
    return prefs.pref_audit(I.pref_with_vectors(spark, sf))


@query(_with(SCORES_SQL) + """SELECT qa_id, prompt, chosen, rejected, round(cosine, 6) AS cosine, round(chrf, 6) AS chrf,
  round(score, 6) AS score, kept, drop_reason FROM audit""")
def pref_audit(spark, sf):
    audit = _audit(spark, sf).drop("chosen_vec_id", "rejected_vec_id")
    return _rounded(audit, "cosine", "chrf", "score")


@query(_with(SCORES_SQL) + "SELECT prompt, chosen, rejected FROM audit WHERE kept")
def pref_kept(spark, sf):
    return prefs.kept_pairs(_audit(spark, sf))


@query(_with(SCORES_SQL) + """SELECT coalesce(drop_reason, 'kept') AS outcome, count(*) AS n_rows FROM audit GROUP BY 1
UNION ALL SELECT 'total', count(*) FROM audit""")
def pref_drop_counts(spark, sf):
    return prefs.drop_counts(_audit(spark, sf)).withColumn("n_rows", F.col("n_rows").cast("bigint"))


LENGTHS_SQL = ", ".join(
    f"CAST(sum({TOKENS_SQL.format(c)}) AS BIGINT) AS {c}_total, round_even(avg({TOKENS_SQL.format(c)}), 1) AS {c}_avg, "
    f"min({TOKENS_SQL.format(c)}) AS {c}_min, max({TOKENS_SQL.format(c)}) AS {c}_max, median({TOKENS_SQL.format(c)}) AS {c}_median"
    for c in ("prompt", "chosen", "rejected")
)


@query(_with(I.PREF_SQL) + f""", ranked AS (SELECT *, row_number() OVER (ORDER BY {ORDER_SQL.format('qa_id')}) AS rn, count(*) OVER () AS n FROM pref)
SELECT CASE WHEN rn <= ceil(ceil(n * 0.25) * 0.25) THEN 'validation' WHEN rn <= ceil(n * 0.25) THEN 'test' ELSE 'train' END AS split,
  count(*) AS n_rows, {LENGTHS_SQL} FROM ranked GROUP BY 1""")
def pref_length_bias(spark, sf):
    return prefs.length_bias(splits.split_exact(I.pref(spark, sf), "qa_id"), "split")


# ------------------------------------------------------------------------------ scoring

PUNCT_SQL = r"[!-/:-@\[-`{-~]"


def _normalised_sql(mode: str, column: str) -> str:
    if mode == "char_strict":
        return f"regexp_replace(lower({column}), '[ \\t\\n\\r]+|{PUNCT_SQL}', '', 'g')"
    kept = f"lambda w: NOT regexp_full_match(w, '{PUNCT_SQL}')"
    return f"array_to_string(list_filter(string_split_regex(lower({column}), '[ \\t\\n\\r]+'), {kept}), '')"


def _f1_sql(mode: str) -> str:
    p, r = _normalised_sql(mode, "prediction"), _normalised_sql(mode, "reference")
    return I.EVAL_SQL + f""",
clean AS (SELECT qa_id, turn, {p} AS p, {r} AS r FROM eval),
chars AS (SELECT qa_id, ch, count(*) FILTER (WHERE side = 'p') AS np, count(*) FILTER (WHERE side = 'r') AS nr FROM (
  SELECT qa_id, 'p' AS side, unnest(string_split(p, '')) AS ch FROM clean
  UNION ALL SELECT qa_id, 'r', unnest(string_split(r, '')) FROM clean) u WHERE ch <> '' GROUP BY ALL),
bags AS (SELECT qa_id, CAST(sum(least(np, nr)) AS BIGINT) AS overlap, sum(np) AS np, sum(nr) AS nr FROM chars GROUP BY qa_id),
scored AS (SELECT c.qa_id, c.turn, CASE WHEN length(p) = 0 AND length(r) = 0 THEN 1.0
  WHEN length(p) = 0 OR length(r) = 0 OR overlap = 0 THEN 0.0
  ELSE 2 * (overlap / np) * (overlap / nr) / (overlap / np + overlap / nr) END AS f1 FROM clean c LEFT JOIN bags USING (qa_id))"""


EM_SQL = f"CASE WHEN trim(prediction, {WS_SQL}) = trim(reference, {WS_SQL}) THEN 1.0 ELSE 0.0 END"


@query(_with(I.EVAL_SQL) + f"SELECT qa_id, CAST({EM_SQL} AS DOUBLE) AS em FROM eval")
def em_trim(spark, sf):
    return scoring.qa_em(I.evaluation(spark, sf)).select("qa_id", "em")


@query(_with(_f1_sql("char_strict")) + "SELECT qa_id, CAST(p = r AS DOUBLE) AS em FROM clean")
def em_normalised(spark, sf):
    return scoring.qa_em(I.evaluation(spark, sf), "normalised").select("qa_id", "em")


@query(_with(_f1_sql("char_loose")) + "SELECT qa_id, round(f1, 6) AS f1 FROM scored")
def f1_char_loose(spark, sf):
    return _rounded(scoring.qa_f1(I.evaluation(spark, sf), "char_loose").select("qa_id", "f1"), "f1")


@query(_with(_f1_sql("char_strict")) + "SELECT qa_id, round(f1, 6) AS f1 FROM scored")
def f1_char_strict(spark, sf):
    return _rounded(scoring.qa_f1(I.evaluation(spark, sf), "char_strict").select("qa_id", "f1"), "f1")


@query(_with(_f1_sql("char_strict")) + "SELECT qa_id, overlap FROM bags")
def bag_intersect(spark, sf):
    cleaned = I.evaluation(spark, sf).select(
        "qa_id", normalise_strict(F.col("prediction")).alias("p"), normalise_strict(F.col("reference")).alias("r")
    )
    return cleaned.select("qa_id", char_bag_overlap(F.col("p"), F.col("r")).cast("bigint").alias("overlap"))


@query(_with(_f1_sql("char_loose")) + f""", ems AS (SELECT qa_id, {EM_SQL} AS em FROM eval)
SELECT turn, count(*) AS n_rows, round(avg(em), 6) AS exact_match, round(avg(f1), 6) AS f1,
  round_even(avg(em) * 100, 2) AS exact_match_pct, round_even(avg(f1) * 100, 2) AS f1_pct
FROM scored JOIN ems USING (qa_id) GROUP BY turn""")
def qa_scores(spark, sf):
    return _rounded(scoring.qa_scores(I.evaluation(spark, sf), "turn"), "exact_match", "f1")


@query(_with(I.MODEL_OUT_SQL) + f"""SELECT qa_id, trim(string_split(output, '<|im_end|>')[1], {WS_SQL}) AS prediction, answer AS reference
FROM model_out""")
def join_eval(spark, sf):
    references = I.qa(spark, sf).select("qa_id", F.col("answer").alias("reference"))
    predictions = answer_cut(spark, sf).withColumnRenamed("answer", "prediction")
    return scoring.join_eval(predictions, references, "qa_id")


@query("""SELECT doc_id, 'right' AS missing_in FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'left' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def join_eval_unmatched(spark, sf):
    return joins.unmatched(
        "doc_id", I.table(spark, sf, "documents").select("doc_id"), I.table(spark, sf, "labels").select("doc_id")
    )


@query(_with(I.NLL_SQL) + """SELECT lang, count(*) AS n_tokens, round(avg(nll), 6) AS loss, round(exp(avg(nll)), 6) AS perplexity
FROM nll WHERE label <> -100 GROUP BY lang""")
def perplexity_by_lang(spark, sf):
    tokens = I.table(spark, sf, "documents").select("doc_id", "lang", F.posexplode(words(F.col("text"))).alias("i", "token"))
    losses = tokens.select(
        "lang", F.log(1 + F.length("token")).alias("nll"), F.when(F.col("i") == 0, -100).otherwise(F.length("token")).alias("label")
    )
    return _rounded(scoring.perplexity(losses, "lang"), "loss", "perplexity")


# ------------------------------------------------------------------------------ profile

DOC_LENGTHS = f"lengths AS (SELECT *, {TOKENS_SQL.format('text')} AS t FROM documents)"


def _stats_sql(source: str, rows: str) -> str:
    return f"""SELECT lang, {rows} AS n_rows, count(*) AS n_tokenized, {rows} > count(*) AS is_estimate,
  CAST(sum(t) AS BIGINT) AS total_tokens_in_sample, CAST(floor(sum(t) / count(*) * {rows}) AS BIGINT) AS est_total_tokens,
  round_even(avg(t), 1) AS avg, min(t) AS min, max(t) AS max, median(t) AS median FROM {source} GROUP BY lang"""


@query(_with(DOC_LENGTHS) + _stats_sql("lengths", "count(*)"))
def token_stats(spark, sf):
    return profiling.token_stats(I.table(spark, sf, "documents"), "text", "doc_id", ("lang",), cap=None)


@query(_with(DOC_LENGTHS) + f""", sample AS (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM lengths
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {ORDER_SQL.format('doc_id')}) <= 100)
""" + _stats_sql("sample", "max(n)"))
def token_stats_sampled(spark, sf):
    return profiling.token_stats(I.table(spark, sf, "documents"), "text", "doc_id", ("lang",), cap=100)


@query(_with(DOC_LENGTHS) + """, edges AS (SELECT CAST(min(t) AS DOUBLE) AS lo, CAST(max(t) AS DOUBLE) AS hi, avg(t) AS mean FROM lengths),
placed AS (SELECT least(CAST(floor((t - lo) * 40 / (hi - lo)) AS INTEGER), 39) AS bin FROM lengths, edges),
bins AS (SELECT CAST(unnest(range(40)) AS INTEGER) AS bin)
SELECT bin, round(lo + bin * ((hi - lo) / 40), 6) AS bin_from, round(lo + (bin + 1) * ((hi - lo) / 40), 6) AS bin_to,
  count(placed.bin) AS n_rows, round(mean, 6) AS mean FROM bins LEFT JOIN placed USING (bin), edges GROUP BY bin, lo, hi, mean""")
def token_hist40(spark, sf):
    return _rounded(profiling.histogram(I.table(spark, sf, "documents"), "text"), "bin_from", "bin_to")


@query(_with(DOC_LENGTHS) + """SELECT doc_id, CASE WHEN t > 256 THEN
  array_to_string(list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda x: x <> '')[1:256], ' ') ELSE text END AS text,
  CAST(t AS INTEGER) AS n_tokens, t > 256 AS over_budget FROM lengths""")
def len_budget(spark, sf):
    return profiling.len_budget(I.table(spark, sf, "documents").select("doc_id", "text"), "text", 256)


@query(_with(DOC_LENGTHS) + """SELECT lang, count(*) AS n_rows, count(*) FILTER (WHERE t > 1024) AS n_over,
  round(avg(CAST(t > 1024 AS INTEGER)), 6) AS share_over FROM lengths GROUP BY lang""")
def len_budget_report(spark, sf):
    docs = I.table(spark, sf, "documents").select("lang", "text")
    return profiling.len_budget_report(profiling.len_budget(docs, "text", 1024), "lang")


@query(_with(RANKED_DOCS) + f""", lengths AS (SELECT lang, {SPLIT_SQL} AS split, {TOKENS_SQL.format('text')} AS t FROM ranked)
SELECT lang, split, count(*) AS n_rows, CAST(sum(t) AS BIGINT) AS total_tokens, round_even(avg(t), 1) AS avg, min(t) AS min, max(t) AS max,
  median(t) AS median, CAST(4 AS INTEGER) AS n_columns FROM lengths GROUP BY ROLLUP (lang, split)""")
def profile_rollup(spark, sf):
    docs = I.table(spark, sf, "documents").select("doc_id", "text", "lang")
    return profiling.profile(splits.split_exact(docs, "doc_id", test=100, validation=50), "text", "lang", "split")


@query("""SELECT 'documents' AS dataset, CAST(1 AS BIGINT) AS n_files, count(*) > 0 AS has_size FROM documents
UNION ALL SELECT 'events', 1, count(*) > 0 FROM events""")
def size_mb(spark, sf):
    """Files of two tables (one each at the scale that is compared) and whether they hold anything."""
    report = None
    for name in ("documents", "events"):
        sizes = profiling.size_mb(spark, f"{sf}/{name}.parquet")
        part = sizes.select(F.lit(name).alias("dataset"), "n_files", (F.col("size_mb") > 0).alias("has_size"))
        report = part if report is None else report.unionByName(part)
    return report


def _profile_sql(lengths: str, keys: str) -> str:
    """Statistics as SQL over a CTE ``lengths`` with the keys, text and t."""
    return f"""{lengths} SELECT {keys}, text, count(*) AS n_rows, count(*) AS n_tokenized, false AS is_estimate,
  CAST(sum(t) AS BIGINT) AS total_tokens_in_sample, CAST(sum(t) AS BIGINT) AS est_total_tokens, round_even(avg(t), 1) AS avg,
  min(t) AS min, max(t) AS max, median(t) AS median, true AS has_size FROM lengths GROUP BY ALL"""


def _profiled(report: DataFrame) -> DataFrame:
    return report.select(
        "dataset", "split", "text", "n_rows", "n_tokenized", "is_estimate", "total_tokens_in_sample", "est_total_tokens", "avg",
        "min", "max", "median", (F.col("size_mb") > 0).alias("has_size"),
    )


@query(_profile_sql(_with(I.PREF_SQL) + f""", ranked AS (SELECT *, row_number() OVER (ORDER BY {ORDER_SQL.format('qa_id')}) AS rn, count(*) OVER () AS n FROM pref),
parts AS (SELECT *, CASE WHEN rn <= ceil(ceil(n * 0.25) * 0.25) THEN 'validation' WHEN rn <= ceil(n * 0.25) THEN 'test' ELSE 'train' END AS split FROM ranked),
lengths AS (SELECT split, 'prompt' AS text, {TOKENS_SQL.format('prompt')} AS t FROM parts UNION ALL SELECT split, 'chosen', {TOKENS_SQL.format('chosen')} FROM parts
  UNION ALL SELECT split, 'rejected', {TOKENS_SQL.format('rejected')} FROM parts)""", "'dpo_data' AS dataset, split"))
def profile_dpo(spark, sf):
    """Preference pairs stored in splits, then all statistics of their three texts."""
    pairs = I.pref(spark, sf).select("qa_id", "prompt", "chosen", "rejected")
    path = writers.write_splits(splits.split_exact(pairs, "qa_id"), scratch_dir(spark, "dpo"))
    return _profiled(jobs.profile_datasets(spark, {"dpo_data": path}, "qa_id", {"dpo_data": ["prompt", "chosen", "rejected"]}))


@query(_profile_sql(_with(I.QA_SQL) + f""", texts AS (SELECT concat({USER_SQL.format('question')}, answer, '<|im_end|>') AS s FROM qa),
lengths AS (SELECT 'text' AS text, {TOKENS_SQL.format('s')} AS t FROM texts)""", "'qa_data' AS dataset, CAST(NULL AS VARCHAR) AS split"))
def profile_raw(spark, sf):
    """A stored table without splits and without text: formatted, then profiled as a whole."""
    path = writers.write_table(I.qa(spark, sf).select("qa_id", "question", "answer"), scratch_dir(spark, "raw"))
    return _profiled(jobs.profile_datasets(spark, {"qa_data": path}, "qa_id"))


@query(f"""WITH lengths AS (SELECT lang, len(regexp_extract_all(text, '[\\p{{L}}\\p{{M}}\\p{{Nd}}_]+|[^\\p{{L}}\\p{{M}}\\p{{Nd}}_\\s]+')) AS t FROM documents)
""" + _stats_sql("lengths", "count(*)"))
def token_stats_tokenizer(spark, sf):
    """Token statistics by a tokenizer that is loaded on the workers."""
    tokens = tokenizer_count("text", "words and marks", split_tokenizer)
    return profiling.token_stats(I.table(spark, sf, "documents"), "text", "doc_id", ("lang",), tokens=tokens)


# ------------------------------------------------------------------------------ run logs


@query(_with(I.RUNLOG_SQL) + """SELECT stage, step, max(value) FILTER (WHERE metric = 'loss') AS loss,
  max(value) FILTER (WHERE metric = 'eval_loss') AS eval_loss, CAST(NULL AS DOUBLE) AS learning_rate FROM series GROUP BY ALL""")
def run_curves(spark, sf):
    return runlogs.run_curves(I.runlog(spark, sf))


@query(_with(I.RUNLOG_SQL) + """SELECT stage, step, max(value) FILTER (WHERE metric = 'loss') AS "rewards/chosen",
  max(value) FILTER (WHERE metric = 'eval_loss') AS "rewards/rejected", CAST(NULL AS DOUBLE) AS "rewards/margins" FROM series GROUP BY ALL""")
def reward_curves(spark, sf):
    """The reward series of a run: one row per step."""
    name = F.when(F.col("metric") == "loss", "rewards/chosen").otherwise("rewards/rejected")
    return runlogs.run_curves(I.runlog(spark, sf).withColumn("metric", name), runlogs.REWARD_METRICS)


@query(_with(I.RUNLOG_SQL) + """SELECT stage, arg_min(step, (value, step)) FILTER (WHERE metric = 'eval_loss') AS best_step,
  min(value) FILTER (WHERE metric = 'eval_loss') AS best_eval_loss, max(step) FILTER (WHERE metric = 'eval_loss') AS last_eval_step,
  max(step) AS latest_step FROM series GROUP BY stage""")
def run_best(spark, sf):
    return runlogs.best_checkpoint(I.runlog(spark, sf))


@query(_with(I.RUNLOG_SQL) + """, checkpoints AS (SELECT stage, step, value, row_number() OVER (PARTITION BY stage ORDER BY step DESC) AS newest,
  row_number() OVER (PARTITION BY stage ORDER BY value, step) AS best FROM series WHERE metric = 'eval_loss')
SELECT stage, step, value AS eval_loss, newest <= 2 AS is_newest, best = 1 AS is_best FROM checkpoints WHERE newest <= 2 OR best = 1""")
def run_keep_last2(spark, sf):
    return runlogs.keep_last(I.runlog(spark, sf), 2)


@query(_with(I.RUNLOG_SQL) + """, marked AS (SELECT *, max(session) OVER (PARTITION BY stage, step) AS last_session FROM runlog)
SELECT stage, session, count(*) AS n_rows, min(step) AS first_step, max(step) AS last_step,
  count(*) FILTER (WHERE session < last_session) AS superseded_steps FROM marked GROUP BY ALL""")
def run_sessions(spark, sf):
    return runlogs.session_counts(I.runlog(spark, sf))


@query(_with(I.RUNLOG_SQL) + """, times AS (SELECT stage, datesub('second', min(ts), max(ts)) AS run_seconds FROM runlog GROUP BY stage)
SELECT stage, arg_min(value, step) FILTER (WHERE metric = 'loss') AS first_loss, arg_max(value, step) FILTER (WHERE metric = 'loss') AS last_loss,
  round(avg(value) FILTER (WHERE metric = 'loss'), 6) AS mean_loss, arg_min(value, step) FILTER (WHERE metric = 'eval_loss') AS first_eval_loss,
  min(value) FILTER (WHERE metric = 'eval_loss') AS best_eval_loss, arg_max(value, step) FILTER (WHERE metric = 'eval_loss') AS last_eval_loss,
  any_value(run_seconds) AS run_seconds FROM series JOIN times USING (stage) GROUP BY stage""")
def run_summary(spark, sf):
    return runlogs.run_summary(I.runlog(spark, sf))


@query(_with(I.RUNLOG_SQL) + "SELECT stage, metric, count(*) AS n_rows FROM runlog WHERE metric = 'eval_loss' GROUP BY ALL")
def run_metric_rows(spark, sf):
    entries = I.runlog(spark, sf).select("stage", "metric", F.create_map("metric", "value").alias("metrics"))
    return runlogs.metric_rows(entries, ("eval_loss",)).groupBy("stage", "metric").agg(F.count("*").alias("n_rows"))


# ------------------------------------------------------------------------------ sources and sinks


@query("SELECT text AS question, CASE WHEN lang = 'en' THEN source ELSE '' END AS answer FROM documents")
def questions_jsonl(spark, sf):
    path = scratch_dir(spark, "questions")
    rows = I.seed_questions(spark, sf).select("question", F.nullif("answer", F.lit("")).alias("answer"))
    rows.write.json(path)  # a missing answer is a missing key
    return readers.read_questions(spark, path)


@query(_with(I.CACHE_SQL) + f"SELECT {CACHE_ROW} FROM cache")
def cache_jsonl(spark, sf):
    path = scratch_dir(spark, "cache")
    log = I.response_log(spark, sf).repartitionByRange("seq").sortWithinPartitions("seq")
    writers.append_jsonl(log.select("query", "response"), path)
    return _flat(readers.read_cache(spark, path))


@query("""WITH starts AS (SELECT event_type AS stage, event_id // 1000 AS k, min(event_id) AS first_id FROM events GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY k) AS session FROM starts)
SELECT e.event_type AS stage, n.session, e.event_id AS step, 'loss' AS metric, e.value
FROM events e JOIN numbered n ON n.stage = e.event_type AND n.k = e.event_id // 1000""")
def runlog_text(spark, sf):
    """Events written as log files, one per type, with a restart line per thousand events, and read back."""
    path = scratch_dir(spark, "logs")
    events = I.table(spark, sf, "events")
    stamp = F.date_format("ts", readers.TIMESTAMP_FORMAT)
    steps = events.select(
        "event_type", "event_id", F.lit(1).alias("o"),
        F.concat(stamp, F.lit(" - INFO - Step "), F.col("event_id").cast("string"), F.lit(": loss="), F.col("value").cast("string")).alias("line"),
    )
    starts = events.groupBy("event_type", F.floor(F.col("event_id") / 1000)).agg(F.min(F.struct("event_id", "ts")).alias("f")).select(
        "event_type", F.col("f.event_id").alias("event_id"), F.lit(0).alias("o"),
        F.concat(F.date_format("f.ts", readers.TIMESTAMP_FORMAT), F.lit(" - INFO - Training started | steps=1")).alias("line"),
    )
    lines = steps.unionByName(starts).repartition("event_type").sortWithinPartitions("event_type", "event_id", "o")
    lines.select("line", "event_type").write.partitionBy("event_type").text(path)
    stage = F.regexp_extract("file", "event_type=([^/]+)/", 1)
    return readers.read_runlog(spark, path).select(stage.alias("stage"), "session", "step", "metric", "value")


@query(_with(RANKED_DOCS) + f"SELECT {SPLIT_SQL} AS split, count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM ranked GROUP BY 1")
def sink_split(spark, sf):
    path = writers.write_splits(split_rows(spark, sf), scratch_dir(spark, "splits"))
    return readers.read_splits(spark, path).groupBy("split").agg(F.count("*").alias("n_rows"), F.sum(F.length("text")).alias("n_chars"))


@query(_with(SCORES_SQL) + """SELECT kept, drop_reason, count(*) AS n_rows FROM audit GROUP BY ALL""")
def sink_audit_json(spark, sf):
    path = writers.write_audit_json(_audit(spark, sf).drop("chosen_vec_id", "rejected_vec_id"), scratch_dir(spark, "audit"))
    audit = spark.read.schema("prompt string, kept boolean, drop_reason string").json(path)
    return audit.groupBy("kept", "drop_reason").agg(F.count("*").alias("n_rows"))


@query(_with(I.RUNLOG_SQL) + """SELECT stage, step, max(value) FILTER (WHERE metric = 'loss') AS loss,
  max(value) FILTER (WHERE metric = 'eval_loss') AS eval_loss FROM series GROUP BY ALL""")
def sink_csv(spark, sf):
    path = writers.write_csv(run_curves(spark, sf), scratch_dir(spark, "curves"))
    schema = "stage string, step bigint, loss double, eval_loss double, learning_rate double"
    return spark.read.schema(schema).option("header", True).csv(path).drop("learning_rate")


@query("SELECT 'v1' AS version, count(*) AS n_rows, 'doc_id,text,lang' AS columns FROM documents")
def publish_manifest(spark, sf):
    docs = I.table(spark, sf, "documents").select("doc_id", "text", "lang")
    manifest = writers.publish_snapshot(docs, scratch_dir(spark, "published"), "v1")
    return manifest.withColumn("columns", F.array_join("columns", ","))


@query("SELECT doc_id, text FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def stage_resume(spark, sf):
    path = scratch_dir(spark, "stage")
    writers.stage_resume(spark, path, "v1", lambda: first_seen_docs(spark, sf))
    stored, _ = writers.stage_resume(spark, path, "v1", lambda: first_seen_docs(spark, sf).limit(0))
    return stored


@query(_with(RANKED_DOCS) + "SELECT concat(text, '<|endoftext|>') AS text FROM ranked WHERE rn > 50 AND rn <= 100")
def load_text_dataset(spark, sf):
    """Resolve, split, format and store the documents, then read the stored test split."""
    where = {"text_data": {"raw": f"{sf}/documents.parquet", "mapped": scratch_dir(spark, "mapped")}}
    return jobs.load_dataset(spark, "text_data", where, {"text_data": {"test": 100, "validation": 50}}, "doc_id", only_test=True).select("text")


def _resolved_sql(origin: str) -> str:
    return f"SELECT '{origin}' AS origin, lang, count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents GROUP BY lang"


def _resolved(spark, places: dict[str, str]) -> DataFrame:
    df, origin = readers.resolve(spark, "text_data", {"text_data": places})
    counts = df.groupBy("lang").agg(F.count("*").alias("n_rows"), F.sum(F.length("text")).alias("n_chars"))
    return counts.select(F.lit(origin).alias("origin"), "lang", "n_rows", "n_chars")


@query(_resolved_sql("mapped"))
def load_mapped(spark, sf):
    """Stored splits are found before the raw table."""
    mapped = writers.write_splits(split_rows(spark, sf).join(I.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id"), scratch_dir(spark, "mapped"))
    return _resolved(spark, {"mapped": mapped, "raw": f"{sf}/documents.parquet"})


@query(_resolved_sql("published"))
def load_published(spark, sf):
    """A published snapshot is used where there is neither a mapped nor a raw table."""
    base = scratch_dir(spark, "published")
    writers.publish_snapshot(I.table(spark, sf, "documents"), base, "v1")
    return _resolved(spark, {"mapped": f"{base}/none", "raw": f"{base}/none", "published": f"{base}/version=v1"})


@query(_with(RANKED_DOCS) + f""", formatted AS (
  SELECT {SPLIT_SQL} AS split, {TOKENS_SQL.format("concat(text, '<|endoftext|>')")} AS t FROM ranked)
SELECT 'text_data' AS dataset, split, 'doc_id,lang,n_chars,source,split,text' AS columns, count(*) AS n_rows, count(*) AS n_tokenized,
  false AS is_estimate, CAST(sum(t) AS BIGINT) AS total_tokens_in_sample, CAST(sum(t) AS BIGINT) AS est_total_tokens,
  round_even(avg(t), 1) AS avg, min(t) AS min, max(t) AS max, median(t) AS median, true AS has_size FROM formatted GROUP BY split""")
def profile_stored(spark, sf):
    """Loads and stores the documents as a dataset, then profiles what is stored."""
    where = {"text_data": {"raw": f"{sf}/documents.parquet", "mapped": scratch_dir(spark, "mapped")}}
    jobs.load_dataset(spark, "text_data", where, {"text_data": {"test": 100, "validation": 50}}, "doc_id")
    report = jobs.profile_datasets(spark, {"text_data": where["text_data"]["mapped"]}, "doc_id", cap=None)
    columns = F.array_join(F.array_sort("columns"), ",").alias("columns")
    return report.select(
        "dataset", "split", columns, "n_rows", "n_tokenized", "is_estimate", "total_tokens_in_sample", "est_total_tokens",
        "avg", "min", "max", "median", (F.col("size_mb") > 0).alias("has_size"),
    )


# ------------------------------------------------------------------------------ batch hook and streaming


@query("SELECT doc_id, reverse(text) AS text FROM documents")
def map_batches(spark, sf):
    """A stand-in model (text reversal) applied to batches of 16 texts."""
    docs = I.table(spark, sf, "documents").select("doc_id", "text")
    return batches.map_batches(docs, lambda frame: frame.assign(text=frame["text"].str[::-1]), 16, docs.schema)


VOWELS = "aeiou "
VECTOR_SQL = "[" + ", ".join(f"CAST(length({{0}}) - length(replace({{0}}, '{v}', '')) + 1 AS DOUBLE)" for v in VOWELS) + "]"


@query(_with(I.QA_SQL) + f""", pairs AS (
  SELECT qa_id, question AS prompt, answer AS chosen, trim(reverse({USER_SQL.format('question')}), {WS_SQL}) AS rejected FROM qa),
vectors AS (SELECT *, {VECTOR_SQL.format('chosen')} AS c, {VECTOR_SQL.format('rejected')} AS r FROM pairs)
SELECT qa_id, prompt, chosen, rejected, round(list_dot_product(c, r) / sqrt(list_dot_product(c, c)) / sqrt(list_dot_product(r, r)), 6) AS cosine
FROM vectors""")
def pref_from_models(spark, sf):
    """Generation and embedding through the batch hook, with stand-in models (reversal, vowel counts)."""
    vowels = VOWELS
    generated = prefs.generate_rejected(
        I.qa(spark, sf).select("qa_id", "question", "answer"), lambda prompts: [p[::-1] for p in prompts]
    )
    embedded = prefs.embed_sides(generated, lambda texts: [[t.count(v) + 1.0 for v in vowels] for t in texts])
    return _rounded(prefs.cosine(embedded).select("qa_id", "prompt", "chosen", "rejected", "cosine"), "cosine")


@query(_with(I.CACHE_SQL) + f"SELECT {CACHE_ROW} FROM cache")
def stream_cache_upsert(spark, sf):
    base = scratch_dir(spark, "stream-cache")
    log = I.response_log(spark, sf).repartitionByRange("seq").sortWithinPartitions("seq")
    writers.append_jsonl(log.select("query", "response"), f"{base}/in")
    return _flat(incremental.stream_cache_upsert(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint"))


@query(SEED_CACHE + f"""SELECT min(s.id) AS id, trim(s.question, {WS_SQL}) AS question, any_value(c.query) IS NOT NULL AS cached
FROM seed s LEFT JOIN cache c ON trim(s.question, {WS_SQL}) = c.query GROUP BY 2""")
def stream_dedupe_enrich(spark, sf):
    base = scratch_dir(spark, "stream-enrich")
    I.seed_questions(spark, sf).write.parquet(f"{base}/in")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("question", T.StringType()), T.StructField("answer", T.StringType())])
    rows = incremental.stream_dedupe_enrich(spark, f"{base}/in", schema, I.cache(spark, sf), f"{base}/out", f"{base}/checkpoint")
    return rows.select("id", "question", F.col("response").isNotNull().alias("cached"))


@query(_with(I.RUNLOG_SQL) + """SELECT stage, arg_min(step, (value, step)) FILTER (WHERE metric = 'eval_loss') AS best_step,
  min(value) FILTER (WHERE metric = 'eval_loss') AS best_eval_loss, max(step) AS latest_step FROM series GROUP BY stage""")
def stream_runlog(spark, sf):
    base = scratch_dir(spark, "stream-runlog")
    runs = I.runlog(spark, sf)
    runs.write.parquet(f"{base}/in")
    return incremental.stream_runlog(spark, f"{base}/in", runs.schema, f"{base}/out", f"{base}/checkpoint")
