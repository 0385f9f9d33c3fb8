"""Input tables of the registered queries, derived by Spark from the provided tables, each with the
SQL text of the same table for the comparison. All of them cover whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.functions.text import utrim
from qaloom.operators.dialogs import pairs_from_dialog
from qaloom.operators.prefs import join_vectors
from qaloom.sources.readers import latest_responses

# Templates per part type; the item replaces {x}.
TEMPLATES = {
    "ECONOMY": ["What is {x}?", "Who makes {x}?", "Where is {x} used?"],
    "LARGE": ["What is {x}?", "How heavy is {x}?"],
    "MEDIUM": ["What is {x}?", "How is {x} stored?"],
    "PROMO": ["Why is {x} popular?", "What is {x}?"],
    "SMALL": ["What is {x}?", "How does {x} work?", "What replaces {x}?", "Where is {x} used?"],
    "STANDARD": ["Which norm covers {x}?", "What is {x}?"],
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- question/answer pairs ------------------------------------------------------------------

QA_SQL = """
turns AS (
  SELECT conv_id, turn, role, text,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
         lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
  FROM conversations),
qa AS (
  SELECT concat(conv_id, '-', turn) AS qa_id, conv_id, turn, text AS question, next_text AS answer
  FROM turns WHERE role = 'user' AND next_role = 'assistant')"""


def qa(spark: SparkSession, sf: str) -> DataFrame:
    return pairs_from_dialog(table(spark, sf, "conversations"))


# --- preference pairs: copies (every 17th), unrelated and edited texts as rejected answers ---------

PREF_SQL = QA_SQL + """,
pref AS (
  SELECT qa_id, question AS prompt, answer AS chosen,
         CASE WHEN (conv_id * 100 + turn) % 17 = 0 THEN answer WHEN turn % 4 = 0 THEN question
              ELSE concat(question, ' ', replace(answer, 'e', 'a')) END AS rejected,
         (conv_id * 13 + turn * 7) % n_vec AS chosen_vec_id,
         CASE WHEN (conv_id * 100 + turn) % 17 = 0 THEN (conv_id * 13 + turn * 7) % n_vec
              ELSE (conv_id * 29 + turn * 11 + 1) % n_vec END AS rejected_vec_id
  FROM (SELECT *, (SELECT count(*) FROM embeddings) AS n_vec FROM qa) x)"""


def pref(spark: SparkSession, sf: str) -> DataFrame:
    n_vec = table(spark, sf, "embeddings").agg(F.count("*").alias("n")).scalar()
    copy = (F.col("conv_id") * 100 + F.col("turn")) % 17 == 0
    own = (F.col("conv_id") * 13 + F.col("turn") * 7) % n_vec
    other = (F.col("conv_id") * 29 + F.col("turn") * 11 + 1) % n_vec
    edited = F.concat("question", F.lit(" "), F.replace("answer", F.lit("e"), F.lit("a")))
    rejected = F.when(copy, F.col("answer")).when(F.col("turn") % 4 == 0, F.col("question")).otherwise(edited)
    return qa(spark, sf).select(
        "qa_id",
        F.col("question").alias("prompt"),
        F.col("answer").alias("chosen"),
        rejected.alias("rejected"),
        own.alias("chosen_vec_id"),
        F.when(copy, own).otherwise(other).alias("rejected_vec_id"),
    )


def pref_with_vectors(spark: SparkSession, sf: str) -> DataFrame:
    sides = {"chosen_vec": "chosen_vec_id", "rejected_vec": "rejected_vec_id"}
    return join_vectors(pref(spark, sf), table(spark, sf, "embeddings"), "qa_id", sides)


# --- predictions: trimmed-equal, edited and unrelated ones -------------------------------------

EVAL_SQL = QA_SQL + """,
eval AS (
  SELECT qa_id, turn, answer AS reference,
         CASE WHEN (conv_id * 100 + turn) % 3 = 0 THEN concat(' ', answer, ' ')
              WHEN (conv_id * 100 + turn) % 3 = 1 THEN concat('! ', replace(answer, 'e', 'E'), ' !')
              ELSE question END AS prediction
  FROM qa)"""


def evaluation(spark: SparkSession, sf: str) -> DataFrame:
    edited = F.concat(F.lit("! "), F.replace("answer", F.lit("e"), F.lit("E")), F.lit(" !"))
    kind = (F.col("conv_id") * 100 + F.col("turn")) % 3
    prediction = (
        F.when(kind == 0, F.concat(F.lit(" "), "answer", F.lit(" "))).when(kind == 1, edited).otherwise(F.col("question"))
    )
    return qa(spark, sf).select("qa_id", "turn", F.col("answer").alias("reference"), prediction.alias("prediction"))


# --- generated texts with and without tool calls -------------------------------------------------

MODEL_OUT_SQL = QA_SQL + """,
model_out AS (
  SELECT qa_id, question, answer, turn, CASE (conv_id + turn) % 4
    WHEN 0 THEN concat('x <tool_call>{"name": "web_search", "arguments": {"query": "q', CAST(qa_id AS VARCHAR),
                       '"}}</tool_call><|im_end|> ', answer)
    WHEN 1 THEN concat(' ', answer, ' <|im_end|>', question)
    WHEN 2 THEN concat('<tool_call>{"name": }</tool_call>', answer)
    ELSE concat(answer, '<tool_call> {"name": "web_search", "arguments": {}} </tool_call>') END AS output
  FROM qa)"""


def model_out(spark: SparkSession, sf: str) -> DataFrame:
    call = F.concat(
        F.lit('x <tool_call>{"name": "web_search", "arguments": {"query": "q'), F.col("qa_id"),
        F.lit('"}}</tool_call><|im_end|> '), "answer",
    )
    plain = F.concat(F.lit(" "), "answer", F.lit(" <|im_end|>"), "question")
    broken = F.concat(F.lit('<tool_call>{"name": }</tool_call>'), "answer")
    bare = F.concat("answer", F.lit('<tool_call> {"name": "web_search", "arguments": {}} </tool_call>'))
    kind = (F.col("conv_id") + F.col("turn")) % 4
    output = F.when(kind == 0, call).when(kind == 1, plain).when(kind == 2, broken).otherwise(bare)
    return qa(spark, sf).select("qa_id", "question", "answer", "turn", output.alias("output"))


# --- seed questions and the response log: documents are the questions, labelled ones have responses ---
# toxic = no results, low quality = no synthesized answer; the lines of the text are the results

SEED_SQL = """
seed AS (
  SELECT doc_id AS id, text AS question, CASE WHEN lang = 'en' THEN source ELSE '' END AS answer FROM documents)"""

CACHE_SQL = """
log AS (
  SELECT doc_id AS seq, trim(text, E' \\t\\n\\r') AS query,
         CASE WHEN quality = 1 THEN concat('  ', lang, ' ', source) ELSE '' END AS answer,
         CASE WHEN toxic = 1 THEN [] ELSE list_transform(string_split(text, chr(10)), lambda line, i: struct_pack(
           title := concat('Line ', i - 1),
           url := CASE WHEN length(line) < 20 THEN '' ELSE concat('https://', source, '.example/', doc_id, '/', i - 1) END,
           content := line)) END AS results
  FROM documents JOIN labels USING (doc_id)),
cache AS (
  SELECT seq, query, answer, results FROM log
  QUALIFY row_number() OVER (PARTITION BY query ORDER BY seq DESC) = 1),
responses AS (
  SELECT seq, query, results,
         CASE WHEN trim(answer) <> '' THEN rtrim(substring(trim(answer), 1, 400), E' \\t\\n\\r')
              WHEN len(results) > 0 THEN rtrim(substring(replace(trim(results[1].content, E' \\t\\n\\r'), chr(10), ' '), 1, 400), E' \\t\\n\\r')
              ELSE '' END AS derived,
         concat('[', array_to_string(list_transform(results[1:3], lambda r: concat(
           '{"title": ', CAST(to_json(r.title) AS VARCHAR), ', "url": ', CAST(to_json(r.url) AS VARCHAR), ', "content": ',
           CAST(to_json(CASE WHEN length(replace(trim(r.content, E' \\t\\n\\r'), chr(10), ' ')) > 600
             THEN concat(rtrim(substring(replace(trim(r.content, E' \\t\\n\\r'), chr(10), ' '), 1, 600), E' \\t\\n\\r'), '...')
             ELSE replace(trim(r.content, E' \\t\\n\\r'), chr(10), ' ') END) AS VARCHAR), '}')), ', '), ']') AS tool_response_json
  FROM cache)"""


def seed_questions(spark: SparkSession, sf: str) -> DataFrame:
    answer = F.when(F.col("lang") == "en", F.col("source")).otherwise("")
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("question"), answer.alias("answer")
    )


def response_log(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")

    def result(line, i):
        url = F.concat(F.lit("https://"), "source", F.lit(".example/"), F.col("doc_id").cast("string"), F.lit("/"), i.cast("string"))
        return F.struct(
            F.concat(F.lit("Line "), i.cast("string")).alias("title"),
            F.when(F.length(line) < 20, "").otherwise(url).alias("url"),
            line.alias("content"),
        )

    lines = F.transform(F.split("text", "\n"), result)
    results = F.when(F.col("toxic") == 1, F.slice(lines, 1, 0)).otherwise(lines)
    answer = F.when(F.col("quality") == 1, F.concat(F.lit("  "), "lang", F.lit(" "), "source")).otherwise("")
    return docs.select(
        F.col("doc_id").alias("seq"),
        utrim(F.col("text")).alias("query"),
        F.struct(answer.alias("answer"), results.alias("results")).alias("response"),
    )


def cache(spark: SparkSession, sf: str) -> DataFrame:
    return latest_responses(response_log(spark, sf), "seq")


# --- run metrics: three sessions per step, every fourth step an evaluation ---------------------------

RUNLOG_SQL = """
runlog AS (
  SELECT event_type AS stage, event_id % 3 AS session, event_id // 3 AS step,
         CASE WHEN (event_id // 3) % 4 = 0 THEN 'eval_loss' ELSE 'loss' END AS metric, value, ts
  FROM events),
series AS (
  SELECT stage, step, metric, value FROM runlog
  QUALIFY row_number() OVER (PARTITION BY stage, step, metric ORDER BY session DESC) = 1)"""


def runlog(spark: SparkSession, sf: str) -> DataFrame:
    step = F.floor(F.col("event_id") / 3)
    return table(spark, sf, "events").select(
        F.col("event_type").alias("stage"),
        (F.col("event_id") % 3).alias("session"),
        step.alias("step"),
        F.when(step % 4 == 0, "eval_loss").otherwise("loss").alias("metric"),
        "value",
        "ts",
    )


# --- question topics: part names by part type -------------------------------------------------------


def topic_items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_type").alias("category"), F.col("p_partkey").alias("item_ord"), F.col("p_name").alias("item")
    )


def _template_values() -> str:
    rows = [
        f"('{category}', {cat_ord}, {i}, '{text}')"
        for cat_ord, (category, texts) in enumerate(TEMPLATES.items()) for i, text in enumerate(texts)
    ]
    return ", ".join(rows)


GRID_SQL = f"""
templates(category, cat_ord, template_ord, template) AS (VALUES {_template_values()}),
grid AS (
  SELECT category, CAST(cat_ord AS INTEGER) AS cat_ord, p_partkey AS item_ord, p_name AS item,
         CAST(template_ord AS INTEGER) AS template_ord, template, replace(template, '{{x}}', p_name) AS question
  FROM part JOIN templates ON p_type = category)"""

# --- token losses: a stand-in that depends on the token only; the first token of a text is masked -----

NLL_SQL = """
nll AS (
  SELECT doc_id, lang, ln(1 + length(token)) AS nll, CASE WHEN i = 1 THEN -100 ELSE length(token) END AS label
  FROM (SELECT doc_id, lang, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS i
        FROM (SELECT doc_id, lang, list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda x: x <> '') AS tokens
              FROM documents)))"""
