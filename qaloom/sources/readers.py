"""Table, JSON-lines and run-log sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom import schemas
from qaloom.functions.jsontext import is_one_json_value
from qaloom.functions.text import is_blank
from qaloom.operators.dedupe import last_written, packed, text_digest
from qaloom.operators.order import running_sum
from qaloom.operators.splits import SPLITS
from qaloom.sources.files import path_exists


def read_columnar(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A saved Parquet table, optionally checked against a fixed schema."""
    df = spark.read.parquet(path)
    return df if schema is None else schemas.conform(df, schema)


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """The three split tables below ``path`` as one table with a ``split`` column.

    A filter on ``split`` prunes the other folders.
    """
    df = spark.read.parquet(path)
    if "split" not in df.columns:
        raise ValueError(f"{path} holds no split=... folders")
    return df


def has_splits(spark: SparkSession, path: str) -> bool:
    """Whether a finished write left all three splits there."""
    return all(path_exists(spark, f"{path}/{part}") for part in ("_SUCCESS", *[f"split={s}" for s in SPLITS]))


def _location(spark: SparkSession, table: str) -> str | None:
    """Folder of a catalog table's files."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return described["data_type"] if described else None


def source_version(spark: SparkSession, place: str) -> str:
    """Changes whenever the source does: a digest of names, sizes and times of its files, those of a catalog table
    included; their contents are not read. A catalog table without files (a view) is told by its rows."""
    location = place if "/" in place else _location(spark, place)
    if location:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location)
        rows = files.select("path", "length", "modificationTime")
    else:
        rows = spark.table(place)
    digest = F.coalesce(F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")), F.lit(0)).cast("string")
    return rows.agg(F.concat_ws("-", F.count("*"), digest).alias("version")).first()["version"]


def resolve(spark: SparkSession, name: str, locations: dict[str, dict[str, str]]) -> tuple[DataFrame, str]:
    """First existing location of a dataset, and which it was: mapped, raw or published.

    ``locations[name]`` maps those three to paths; ``published`` may also be a catalog table.
    """
    places, schema = locations[name], schemas.DATASETS.get(name)
    if places.get("mapped") and has_splits(spark, places["mapped"]):
        return read_splits(spark, places["mapped"]), "mapped"
    if places.get("raw") and path_exists(spark, places["raw"]):
        return read_columnar(spark, places["raw"], schema), "raw"
    published = places.get("published")
    if published and "/" not in published and spark.catalog.tableExists(published):
        return spark.table(published), "published"
    if published and "/" in published and path_exists(spark, published):
        return read_columnar(spark, published, schema), "published"
    raise FileNotFoundError(f"no location of {name!r} exists: {places}")


def parse_questions(lines: DataFrame, strict: bool = True) -> DataFrame:
    """question, answer ("" by default) from a ``value`` column of JSON lines.

    Blank lines and objects without a question are dropped. A corrupt line is an error, or with
    ``strict=False`` dropped.
    """
    line = F.col("value")
    ok = is_one_json_value(line)
    usable = lines.where(~is_blank(line))
    if strict:
        error = F.raise_error(F.concat(F.lit("corrupt question line: "), F.substring(line, 1, 100)))
        usable = usable.withColumn("value", F.when(ok, line).otherwise(error.cast("string")))
    else:
        usable = usable.where(ok)
    row = F.from_json("value", schemas.QA)
    return (
        usable.select(row.alias("r"))
        .where(F.col("r.question").isNotNull())
        .select(F.col("r.question").alias("question"), F.coalesce("r.answer", F.lit("")).alias("answer"))
    )


def read_questions(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return parse_questions(spark.read.text(path), strict)


def number_questions(questions: DataFrame) -> DataFrame:
    """Adds ``id``: the digest of question and answer, and the row's ordinal among equal rows.

    The same lines get the same ids in whatever files they come. Equal rows are counted in chunks of their input
    positions, so one question with a third of all rows is many tasks.
    """
    key = F.md5(F.concat_ws("\0", "question", "answer"))
    rows = questions.withColumns({"_key": key, "_line": F.monotonically_increasing_id()})
    counted = running_sum(rows.withColumn("_chunk", F.floor(F.col("_line") / 4096)), ["_key"], "_chunk", "_line", F.lit(1), "_nth")
    return counted.select(F.concat("_key", F.lit("-"), F.col("_nth").cast("string")).alias("id"), *questions.columns)


def _line_order() -> list:
    """File, start of the file split, and a number that grows with the line inside the split."""
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    ]


def parse_cache(lines: DataFrame) -> DataFrame:
    """query, response of every readable log line in ``value``; corrupt lines are skipped."""
    row = F.from_json("value", schemas.CACHE)
    return (
        lines.where(is_one_json_value(F.col("value")))
        .withColumn("_r", row)
        .withColumns({"query": F.col("_r.query"), "response": F.col("_r.response")})
        .where(F.col("query").isNotNull())
        .drop("value", "_r")
    )


def latest_responses(log: DataFrame, order: str) -> DataFrame:
    """Last written response per query; ``order`` is a number that grows with the writes, unique per query."""
    return last_written(log, "query", F.col(order)).select("query", "response")


def latest_lines(entries: DataFrame, lines: DataFrame) -> DataFrame:
    """The last entry per query with its ``number``, the position of its line among all ``lines``.

    Lines are numbered by file name, then position, through a table with one row per file split. Queries are compared as
    digests, and the winners' entries are fetched by line, so responses move once.
    """
    splits = lines.groupBy("file", "block").agg(F.min("line").alias("first"), (F.max("line") - F.min("line") + 1).alias("n"))
    earlier = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    narrow = entries.select(text_digest("query").alias("key"), "file", "block", "line").join(offsets, ["file", "block"])
    numbered = narrow.select("key", "line", (F.col("offset") + F.col("line") - F.col("first")).alias("number"))
    return _last_entries(entries, numbered)


def _last_entries(entries: DataFrame, numbered: DataFrame) -> DataFrame:
    """The entries whose ``number`` is the largest of their query; ``numbered`` has key, line and number, no responses."""
    winners = numbered.groupBy("key").agg(F.max_by("line", "number").alias("line"), F.max("number").alias("number"))
    return entries.drop("file", "block").join(winners.drop("key"), "line").drop("line")


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with what orders them: file, split, and a number that is unique and grows with the line in a split."""
    return spark.read.text(path).select("value", *_line_order())


def file_ranks(spark: SparkSession, path: str) -> DataFrame:
    """``file, rank``: the files below a path in the order of their names, from the listing; no content is read."""
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"))
    return files.select("file", F.row_number().over(Window.orderBy("file")).alias("rank"))


def read_cache(spark: SparkSession, path: str, broadcast_files: int = 100_000) -> DataFrame:
    """Append log -> latest response per query. Files are ordered by name, lines by position.

    A line's place is its file's rank in the listing, the start of its split and its number in there, so the log is read
    twice: for digests and places, and for the last entries themselves. Up to ``broadcast_files`` ranks are broadcast;
    those of more files are joined by file.
    """
    entries, ranks = parse_cache(log_lines(spark, path)), file_ranks(spark, path)
    if ranks.count() <= broadcast_files:
        ranks = F.broadcast(ranks)
    row = F.col("line") % (1 << 33)  # the number in its task, which grows within the split
    place = packed(("rank", 30), ("block", 46), (row, 33)).alias("number")
    numbered = entries.select(text_digest("query").alias("key"), "file", "block", "line").join(ranks, "file").select("key", "line", place)
    return _last_entries(entries, numbered).drop("number")


# Layout of one log line, of a metric event, and the mark of a (re)start.
LOG_LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}) - (\w+) - (.*)$"
STEP_EVENT = r"^Step (\d+): (.*)$"
START_MARK = r"(?i)\btrain(?:ing|nig) started"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss,SSS"


def parse_log_events(lines: DataFrame) -> DataFrame:
    """Adds ts, level, message, is_start, step and the ``metrics`` map to a ``value`` column of log lines.

    Lines without the time-stamped layout (continuations) are dropped.
    """
    part = {n: F.regexp_extract("value", LOG_LINE, i) for i, n in ((1, "_ts"), (2, "level"), (3, "message"))}
    step = F.regexp_extract("message", STEP_EVENT, 1)
    pairs = F.str_to_map(F.regexp_extract("message", STEP_EVENT, 2), F.lit(", "), F.lit("="))
    return (
        lines.withColumns(part)
        .where(F.col("_ts") != "")
        .withColumns({
            "ts": F.to_timestamp("_ts", TIMESTAMP_FORMAT),
            "is_start": F.col("message").rlike(START_MARK),
            "step": F.nullif(step, F.lit("")).cast("bigint"),
            "metrics": F.when(step != "", F.transform_values(pairs, lambda k, v: v.try_cast("double"))),
        })
        .drop("value", "_ts")
    )


def read_runlog(spark: SparkSession, path: str) -> DataFrame:
    """Log files -> (file, stage, session, step, ts, metric, value).

    ``session`` counts the start lines of the file so far; ``stage`` is the file name without suffix.
    Sessions are counted per file split, so one huge log is not one task.
    """
    lines = spark.read.text(path).select("value", *_line_order())
    events = parse_log_events(lines)
    numbered = running_sum(events, ["file"], "block", "line", F.col("is_start").cast("bigint"), "session")
    stage = F.regexp_extract("file", r"([^/]+?)(\.[^./]*)?$", 1)
    return (
        numbered.where(F.col("step").isNotNull())
        .select("file", stage.alias("stage"), "session", "step", "ts", F.explode("metrics").alias("metric", "value"))
    )
