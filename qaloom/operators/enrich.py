"""Questions joined with cached search responses, assembled into tool-use rows.

Per question in seeded order: blank rows are passed over, a repeated question is skipped, a question
without a usable response is skipped, and the job ends once ``limit`` rows are kept. Since dedupe
precedes the lookup, everything that decides a row's fate is narrow (ids, digests and flags). It is
computed once into a stored table (``prepare``), from which rows, counters and work list are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.functions.jsontext import json_array, json_object, json_string
from qaloom.functions.text import cut, cut_with_dots, one_line, utrim, value_or
from qaloom.operators.dedupe import text_digest as _digest
from qaloom.operators.filters import flt_blank_answer, flt_blank_question, has_results
from qaloom.operators.formats import TOOLS_JSON, tool_call_json
from qaloom.operators.joins import lookup
from qaloom.operators.order import at_or_before, position_number
from qaloom.operators.splits import oversample_limit
from qaloom.schemas import require_columns
from qaloom.session import scratch_dir
from qaloom.sources.files import remove_path

COUNTERS = ("kept", "cache_hits", "api_calls", "skipped_empty", "skipped_dupe")


def top_results(results: Column, k: int) -> Column:
    """The first k results in their original order; empty for null."""
    empty = F.array().cast("array<struct<title:string,url:string,content:string>>")
    return F.slice(F.coalesce(results, empty), 1, k)


def tool_response_json(response: Column, k: int = 3, chars: int = 600) -> Column:
    """JSON array of the top results with one-line contents cut at ``chars``."""
    items = F.transform(
        top_results(response["results"], k),
        lambda r: json_object(
            title=json_string(r["title"]),
            url=json_string(r["url"]),
            content=json_string(cut_with_dots(one_line(r["content"]), chars)),
        ),
    )
    return json_array(items)


def derived_answer(response: Column, chars: int = 400) -> Column:
    """The response's own answer, else the content of its first result; cut, possibly empty."""
    own = utrim(F.coalesce(response["answer"], F.lit("")))
    first = one_line(F.try_element_at(response["results"], F.lit(1))["content"])
    return cut(value_or(own, F.coalesce(first, F.lit(""))), chars)


def sources_list(df: DataFrame, id_col: str, k: int = 3) -> DataFrame:
    """(id, pos, title, url) of the top results that have a URL; the title falls back to the URL."""
    return (
        df.select(id_col, F.posexplode(top_results(F.col("response.results"), k)).alias("pos", "r"))
        .where(F.coalesce("r.url", F.lit("")) != "")
        .select(id_col, "pos", value_or(F.col("r.title"), F.col("r.url")).alias("title"), F.col("r.url").alias("url"))
    )


def join_cache(questions: DataFrame, cache: DataFrame, id_col: str, question: str = "question") -> DataFrame:
    """Every question with the cached response of its trimmed text, or null."""
    keyed = questions.withColumn("_q", _digest(utrim(F.col(question))))
    return lookup(keyed, cache.select(_digest(F.col("query")).alias("_c"), "response"), "_q", "_c", id_col).drop("_q")


def cache_hits(questions: DataFrame, cache: DataFrame, question: str = "question") -> DataFrame:
    """Distinct non-blank questions that have a cached response."""
    return _distinct_questions(questions, question).join(_cached_keys(cache), "key", "left_semi").drop("key")


def missing_queries(questions: DataFrame, cache: DataFrame, question: str = "question") -> DataFrame:
    """Distinct non-blank questions still to be fetched."""
    return _distinct_questions(questions, question).join(_cached_keys(cache), "key", "left_anti").drop("key")


def _distinct_questions(questions: DataFrame, question: str) -> DataFrame:
    """Grouped by the digest that the cache is then joined on, so the texts are shuffled once."""
    trimmed = questions.select(utrim(F.col(question)).alias("question")).transform(flt_blank_question)
    return trimmed.withColumn("key", _digest(F.col("question"))).dropDuplicates(["key"])


def _cached_keys(cache: DataFrame) -> DataFrame:
    return cache.select(_digest(F.col("query")).alias("key"))


def _usable() -> Column:
    """A first-seen row is kept if it has results and either an answer of its own or a derived one."""
    return F.col("has_results") & (F.col("has_answer") | F.col("derivable"))


class Enrichment:
    """One configured run over a question table and a cache table.

    questions: id, question, answer; cache: one row per query with its response, or with ``order`` an append
    log, of which the row with the largest ``order`` counts per query (a number unique in the log).
    ``require_answer`` is the ground-truth mode; without it a missing answer is derived from the response.
    ``oversample`` bounds the candidates to limit * oversample rows.

    ``prepare`` decides every row's fate and stores it; then ``rows``, ``counters`` and ``missing`` can be used, and
    ``release`` removes the stored table. It lies in a new folder per run, below ``scratch`` if that is given.
    """

    def __init__(self, questions: DataFrame, cache: DataFrame, id_col: str = "id", limit: int | None = None,
                 oversample: int = 1, seed: int = 42, require_answer: bool = True, k: int = 3, chars: int = 600,
                 answer_chars: int = 400, tools_json: str = TOOLS_JSON, scratch: str | None = None, order: str | None = None):
        require_columns(questions, id_col, "question", "answer")
        require_columns(cache, "query", "response")
        self.id_col, self.limit, self.seed = id_col, limit, seed
        self.k, self.chars, self.answer_chars, self.tools_json = k, chars, answer_chars, tools_json
        trimmed = questions.select(
            id_col,
            utrim(F.coalesce("question", F.lit(""))).alias("question"),
            utrim(F.coalesce("answer", F.lit(""))).alias("answer"),
        )
        self.cache, self.order, self.scratch, self._status = cache, order, scratch, None
        self.questions = trimmed
        candidates = oversample_limit(trimmed, id_col, limit, oversample, seed)
        self.candidates = candidates.transform(flt_blank_question).transform(flt_blank_answer, require_answer)

    def decide(self) -> DataFrame:
        """id, question key, response key, cache hit and status (kept | empty) of every first-seen candidate; no texts.

        Both the first candidate of a question and the last response of a query are found on digests, flags and numbers.
        """
        narrow = self.candidates.select(
            F.col(self.id_col),
            _digest(F.col("question")).alias("key"),
            (F.col("answer") != "").alias("has_answer"),
            position_number(self.id_col, self.seed).alias("_at"),
        )
        firsts = narrow.groupBy("key").agg(*[F.min_by(c, "_at").alias(c) for c in (self.id_col, "has_answer")])
        responses = self.cache.select(
            _digest(F.col("query")).alias("key"),
            has_results(F.col("response")).alias("has_results"),
            self._derivable(),
            *self._response_key(),
        )
        if self.order:
            flags = [F.max_by(c, "response_key").alias(c) for c in ("has_results", "derivable")]
            responses = responses.groupBy("key").agg(*flags, F.max("response_key").alias("response_key"))
        flags = {c: F.coalesce(c, F.lit(False)) for c in ("has_results", "derivable")} | {"cached": F.col("response_key").isNotNull()}
        return (
            firsts.join(responses, "key", "left")
            .withColumns(flags)
            .select(self.id_col, "key", "response_key", "cached", F.when(_usable(), "kept").otherwise("empty").alias("status"))
        )

    def _response_key(self) -> list[Column]:
        """What a response is fetched by: its place in the log, or the digest of its query."""
        return [(F.col(self.order) if self.order else _digest(F.col("query"))).alias("response_key")]

    def prepare(self) -> Enrichment:
        """Decides and stores; runs a job."""
        decided = self.decide()
        self._path = scratch_dir(decided.sparkSession, "status", self.scratch)
        decided.write.parquet(self._path)
        self._status = decided.sparkSession.read.schema(decided.schema).parquet(self._path)
        return self

    def status(self) -> DataFrame:
        """The decisions that ``prepare`` has stored."""
        if self._status is None:
            raise RuntimeError("call prepare() first")
        return self._status

    def release(self) -> None:
        """Removes the stored decisions; what was derived from them has to be written before."""
        if self._status is not None:
            remove_path(self._status.sparkSession, self._path)
            self._status = None

    def _derivable(self) -> Column:
        return (derived_answer(F.col("response"), self.answer_chars) != "").alias("derivable")

    def _visited(self) -> Column:
        """Rows the job reaches: not after the ``limit``-th kept row."""
        if self.limit is None:
            return F.lit(True)
        return at_or_before(self.status(), self.id_col, self.limit, self.seed, where=F.col("status") == "kept")

    def rows(self) -> DataFrame:
        """The kept tool-use rows, with their id."""
        ids = self.status().where((F.col("status") == "kept") & self._visited()).select(self.id_col, "response_key")
        responses = self.cache.select(*self._response_key(), "response")
        joined = self.questions.join(ids, self.id_col).join(responses, "response_key")
        answer = value_or(F.col("answer"), derived_answer(F.col("response"), self.answer_chars))
        return joined.select(
            self.id_col,
            F.lit(self.tools_json).alias("tools_json"),
            "question",
            tool_call_json(F.col("question")).alias("tool_call_json"),
            tool_response_json(F.col("response"), self.k, self.chars).alias("tool_response_json"),
            answer.alias("answer"),
        )

    def counters(self) -> DataFrame:
        """One row: kept, cache_hits, api_calls, skipped_empty, skipped_dupe over the visited rows."""
        firsts = self.status().where(self._visited()).agg(
            F.count_if(F.col("status") == "kept").alias("kept"),
            F.count_if("cached").alias("cache_hits"),
            F.count_if(~F.col("cached")).alias("api_calls"),
            F.count_if(F.col("status") == "empty").alias("skipped_empty"),
            F.count("*").alias("n_first"),
        )
        reached = self.candidates.select(self.id_col).where(self._visited()).agg(F.count("*").alias("n")).scalar()
        return firsts.withColumn("skipped_dupe", reached - F.col("n_first")).select(*COUNTERS)

    def missing(self) -> DataFrame:
        """Work list: the visited questions that have no cached response yet, as many as ``api_calls`` counts."""
        ids = self.status().where(~F.col("cached") & self._visited()).select(self.id_col)
        return self.questions.join(ids, self.id_col, "left_semi").select("question")


def enrich(questions: DataFrame, cache: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(tool-use rows, counters); options as in ``Enrichment``."""
    run = Enrichment(questions, cache, **options).prepare()
    return run.rows(), run.counters()
