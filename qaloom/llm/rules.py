"""Quality rules as a ledger of failure bits, with versioned policies over it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.llm.common import SPACES, word_array

WINDOW = 8
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A named condition over the measurements that a bad document meets."""

    name: str
    fails: str


# Bit i of the ledger belongs to the i-th rule. Append only: stored ledgers keep their meaning.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("odd_word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("many_symbols", "10 * n_symbols > 2 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("very_long_word", "max_word_chars > 1000"),
)
BASE = ("few_words", "repeated_words")
POLICIES = {
    "v1": BASE,
    "v2": (*BASE, "odd_word_length", "many_symbols", "repeated_lines"),
    "v3": tuple(r.name for r in RULES),
}
CURRENT = "v2"


def mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: 1 << i for i, r in enumerate(rules)}
    return sum(bits[n] for n in set(names))


def _n_repeat_words(pairs: Column) -> Column:
    """Words covered by the windows whose hash occurs twice or more; ``pairs`` are (hash, place), sorted."""

    def is_hash(x: Column, i: Column) -> Column:
        return F.coalesce(F.get(pairs, i)["h"] == x["h"], F.lit(False))

    twice = F.filter(pairs, lambda x, i: is_hash(x, i - 1) | is_hash(x, i + 1))
    places = F.sort_array(F.transform(twice, lambda x: x["at"]))

    def total(at: Column) -> Column:
        steps = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda s, x: s + x)

    return total(places)


def measure(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All measurements of every whole text, in the row (no shuffle)."""
    text = F.coalesce(docs[text_col], F.lit(""))
    step = docs.select(docs[id_col].alias("doc_id"), text.alias("t"))
    step = step.select("doc_id", "t", word_array(F.col("t")).alias("words"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.translate(x, SPACES, "") != "")
    step = step.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.translate("t", SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.coalesce(F.array_max(F.transform("words", F.length)), F.lit(0)).cast("bigint").alias("max_word_chars"),
        lines.alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    last = F.size("hashes") - WINDOW
    windows = F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice("hashes", i + 1, WINDOW))))
    kept = ("doc_id", "n_words", "word_chars", "n_symbols", "max_word_chars")
    step = step.select(
        *kept, F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"), windows.alias("windows"),
    )
    kept = (*kept, "n_lines", "n_dup_lines")
    # Only texts with a repeated window pay for the sort.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    pairs = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    step = step.select(*kept, F.when(repeats, pairs).alias("pairs"))
    covered = F.when(F.col("pairs").isNotNull(), _n_repeat_words(F.col("pairs"))).otherwise(0)
    return step.select(*kept, covered.cast("bigint").alias("n_repeat_words"))


def ledger(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measurements and ``fail_bits`` (bit i: the i-th rule fails) of every row: each rule is evaluated once.

    Null text counts as empty (no words, so ``few_words`` fails); null ids, repeated rows and other columns pass
    through as rows of their own or not at all. One row per input row, built-in functions only, no shuffle.
    """
    bits = F.lit(0).cast("bigint")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(0).cast("bigint"))
    return measure(docs, id_col=id_col, text_col=text_col).withColumn("fail_bits", bits)


def apply_policy(ledger: DataFrame, version: str = CURRENT, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Verdict of a policy version from the stored bits: ``base_failed``, ``kept``, ``policy``."""
    fails = lambda names: F.col("fail_bits").bitwiseAND(F.lit(mask(names, rules)).cast("bigint")) != 0
    return ledger.withColumns({
        "base_failed": fails(BASE), "kept": ~fails((*BASE, *POLICIES[version])), "policy": F.lit(version),
    })


def ablations(ledger: DataFrame, version: str = CURRENT, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail nothing else of the policy (dropping the rule would
    keep them), and that the policy rejects in all. One count per distinct bit pattern, then sums over those."""
    names = tuple(dict.fromkeys((*BASE, *POLICIES[version])))
    patterns = ledger.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask(names, rules)).cast("bigint")).alias("bits")).count()
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(mask((n,), rules)).cast("bigint").alias("bit")) for n in names]))
    rows = patterns.select("bits", "count", each.alias("r")).select("bits", "count", "r.rule", "r.bit")
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("count"))), F.lit(0)).cast("bigint")
    return rows.groupBy("rule").agg(
        total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(F.col("bits") == F.col("bit")).alias("n_only_this"),
        total(F.col("bits") != 0).alias("n_rejected"),
    ).withColumn("policy", F.lit(version))
