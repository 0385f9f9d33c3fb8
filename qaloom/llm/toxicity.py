"""Toxicity by a classifier chain over label categories."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qaloom.llm.common import id_text
from qaloom.llm.hashing import mix

GRAM = 5  # bytes
BUCKETS = 1 << 18
_BLOCK = 1 << 20
_SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def _grams(body: bytes) -> Iterator[np.ndarray]:
    """Buckets of all byte grams of a text (ASCII lower case, white space as blanks), block by block."""
    data = np.frombuffer(b" " + body.lower().translate(_SPACE) + b"    ", np.uint8)
    for i in range(0, len(data) - GRAM + 1, _BLOCK):
        part = data[i : i + _BLOCK + GRAM - 1].astype(np.uint64)
        n = len(part) - GRAM + 1
        key = part[:n].copy()
        for k in range(1, GRAM):
            key |= part[k : k + n] << np.uint64(8 * k)
        yield ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)


@dataclass
class Chain:
    """Linear models in turn: the weights of the selected features, of the earlier categories, and the bias."""

    categories: list[str]
    slot: np.ndarray  # bucket -> feature, or the number of features where it is not used
    weights: list[np.ndarray]
    earlier: list[np.ndarray]
    bias: list[float]

    def present(self, body: bytes) -> np.ndarray:
        found = np.zeros(len(self.weights[0]) + 1, bool)
        for grams in _grams(body):
            found[self.slot[grams]] = True
        return found[:-1]

    def probabilities(self, body: bytes) -> list[float]:
        found, out = self.present(body), []
        for w, v, b in zip(self.weights, self.earlier, self.bias, strict=True):
            z = float(w[found].sum() + b + np.dot(v, out))
            out.append(1.0 / (1.0 + float(np.exp(-np.clip(z, -30, 30)))))
        return out


class _Rows:
    """Sparse 0/1 rows with dense columns beside them."""

    def __init__(self, rows: list[np.ndarray], width: int, dense: np.ndarray):
        self.sizes = np.array([len(r) for r in rows])
        self.at = np.concatenate([np.zeros(0, np.int64), *rows])
        self.row = np.repeat(np.arange(len(rows)), self.sizes)
        self.n, self.width, self.dense = len(rows), width, dense

    def times(self, w: np.ndarray) -> np.ndarray:
        sparse, dense = w[: self.width], w[self.width :]
        return np.bincount(self.row, sparse[self.at], self.n) + self.dense @ dense

    def transposed(self, r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.at, r[self.row], self.width), self.dense.T @ r])


def _fit(rows: list[np.ndarray], dense: np.ndarray, y: np.ndarray, width: int, rounds: int = 100, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression with a small ridge, by accelerated gradient steps; weights, dense weights, bias.

    Each column is first scaled by its own curvature, so that rare features are learnt as fast as common ones.
    """
    dense = np.column_stack([dense, np.ones(len(rows))])
    x = _Rows(rows, width, dense)
    own = np.concatenate([np.bincount(x.at, minlength=width), (dense**2).sum(axis=0)])
    scale = 1 / np.sqrt(0.25 * own + ridge)
    penalty = ridge * scale**2
    penalty[-1] = 0
    w = ahead = np.zeros(width + dense.shape[1])
    v, size = np.ones(x.n), 1.0  # power iteration: the largest curvature gives the step
    for _ in range(12):
        v = x.times(scale**2 * x.transposed(v))
        size = np.linalg.norm(v) or 1.0
        v /= size
    step, t = 1.0 / (0.25 * size * 1.05 + penalty.max()), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x.times(scale * ahead), -30, 30)))
        new = ahead - step * (scale * x.transposed(p - y) + penalty * ahead)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + (before - 1) / t * (new - w), new
    return scale * w


def _select(rows: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Buckets whose presence tells most about some category (largest standardised difference of frequencies)."""
    flat, owner = np.concatenate([np.zeros(0, np.int32), *rows]), np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    total, score = np.bincount(flat, minlength=BUCKETS), np.zeros(BUCKETS)
    for y in labels.T:
        share = y.mean()
        hits = np.bincount(flat, y[owner], BUCKETS)
        spread = np.sqrt(np.maximum(total * share * (1 - share), 1e-9)) + 1
        score = np.maximum(score, np.abs(hits - total * share) / spread)
    score[total < 3] = 0
    best = np.argsort(-score, kind="stable")[:size]
    return np.sort(best[score[best] > 0])


def _narrowed(rows: list[np.ndarray], labels: np.ndarray, among: np.ndarray, features: int) -> tuple[np.ndarray, int, list[np.ndarray]]:
    """Features chosen by the rows ``among`` alone: bucket -> feature, their number, and all rows in terms of them."""
    chosen = _select([rows[j] for j in among], labels[among], features) if len(among) else np.zeros(0, np.int64)
    width = len(chosen)
    slot = np.full(BUCKETS, width, np.int32)
    slot[chosen] = np.arange(width)
    return slot, width, [s[s < width] for s in (slot[r] for r in rows)]


def out_of_fold(rows: list[np.ndarray], labels: np.ndarray, fold: np.ndarray, features: int = 2048) -> np.ndarray:
    """For every category, what models that have not seen a row say about it, with the earlier categories' such values as
    inputs. Everything about a fold's models, the choice of features included, comes from the other folds."""
    views = []
    for k in np.unique(fold).tolist():
        inside, outside = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        views.append((inside, outside, *_narrowed(rows, labels, inside, features)[1:]))
    seen = np.zeros((len(rows), 0))
    for y in labels.T.astype(float):
        out = np.full(len(rows), y.mean() if len(rows) else 0.0)
        for inside, outside, width, kept in views:
            if len(inside):
                part = _fit([kept[j] for j in inside], seen[inside], y[inside], width)
                z = _Rows([kept[j] for j in outside], width, np.column_stack([seen[outside], np.ones(len(outside))])).times(part)
                out[outside] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        seen = np.column_stack([seen, out])
    return seen


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, categories: list[str], fold: np.ndarray, *, features: int = 2048) -> Chain:
    """The chain from bucket sets, 0/1 labels (a column per category, in chain order) and the rows' folds.

    A later model is trained on what earlier ones, fitted without the row's fold, say about the row (``out_of_fold``), as
    that is what it will get when it scores new texts. The models used for scoring are fitted on all rows.
    """
    slot, width, kept = _narrowed(rows, labels, np.arange(len(rows)), features)
    unseen = out_of_fold(rows, labels[:, :-1], fold, features)
    chain = Chain(categories, slot, [], [], [])
    for i in range(len(categories)):
        w = _fit(kept, unseen[:, :i], labels[:, i].astype(float), width) if len(rows) else np.concatenate([np.zeros(width + i), [-30.0]])
        chain.weights.append(w[:width])
        chain.earlier.append(w[width:-1])
        chain.bias.append(float(w[-1]))
    return chain


def train(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str], *, max_rows: int = 6_000, folds: int = 4,
    id_col: str = "doc_id", text_col: str = "text",
) -> Chain:
    """Fits the chain on at most ``max_rows`` labelled documents, those with the least hash of their id.

    ``categories``: name -> SQL condition over ``labels``, in chain order. Rows whose condition is null are not used; of
    several labels or texts of one id one counts (the text with the least hash). Folds go by the id's hash. The bound makes
    the sample's ids fit a broadcast and its features the driver: a row is at most its distinct buckets.
    """
    named = [F.expr(c).cast("int").alias(f"y{i}") for i, c in enumerate(categories.values())]
    truth = labels.select(labels[id_col].cast("bigint").alias("doc_id"), *named).dropna().dropDuplicates(["doc_id"])
    sample = truth.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    labelled = id_text(docs, id_col, text_col).join(F.broadcast(sample), "doc_id")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("body"), "body"))
    rows = labelled.withColumn("nth", nth).where("nth = 1").drop("nth")

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(np.concatenate([np.unique(g) for g in _grams(b.as_py())])).astype(np.int32) for b in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int32())), *batch.columns[2:]],
                ["doc_id", "buckets", *(f"y{i}" for i in range(len(categories)))],
            )

    schema = "doc_id bigint, buckets array<int>, " + ", ".join(f"y{i} int" for i in range(len(categories)))
    got = rows.mapInArrow(buckets, schema).toArrow().combine_chunks().sort_by("doc_id")
    sets = got.column("buckets").combine_chunks()
    flat, ends = sets.flatten().to_numpy(), np.cumsum([len(s) for s in sets])
    y = np.column_stack([got.column(f"y{i}").to_numpy() for i in range(len(categories))])
    fold = (mix(got.column("doc_id").to_numpy().astype(np.int64).view(np.uint64)) % np.uint64(folds)).astype(np.int64)
    return fit_chain(np.split(flat, ends[:-1]) if len(ends) else [], y, list(categories), fold)


def score(
    docs: DataFrame, chain: Chain, reject: str, threshold: float = 0.5, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``p_<category>`` for each, and ``rejected`` (the category ``reject`` reaches the threshold).

    One row per input row, whole texts, no shuffle. Null and empty texts are scored as texts without words. Null ids
    and repeated rows pass through; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{c}" for c in chain.categories]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            p = np.array([model.probabilities(b.as_py()) for b in batch.column(1)]).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(p[:, i]) for i in range(len(names)))], ["doc_id", *names])

    schema = "doc_id bigint, " + ", ".join(f"{n} double" for n in names)
    scored = id_text(docs, id_col, text_col).mapInArrow(compute, schema)
    return scored.withColumn("rejected", F.col(f"p_{reject}") >= threshold)


def probability(spark: SparkSession, text: Column, chain: Chain, category: str) -> Column:
    """The probability of one category as a column (null text: that of an empty text)."""
    shared, at = spark.sparkContext.broadcast(chain), chain.categories.index(category)

    @F.pandas_udf("double")
    def compute(bodies: pd.Series) -> pd.Series:
        model = shared.value
        return pd.Series([model.probabilities(b or b"")[at] for b in bodies], dtype="float64")

    return compute(text.cast("binary"))


# The categories of the labels table; what a text is like otherwise helps to tell abuse from noise.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that the chain does not find toxic; the verdict is made in the row.

    Null and empty texts are judged as texts without words; rows without an id and repeated rows each for themselves.
    Without labels all stay.
    """
    chain = train(docs, labels, CATEGORIES, text_col=text_col)
    return docs.where(probability(docs.sparkSession, docs[text_col], chain, "toxic") < threshold)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Chain fitted on ``labels`` (``doc_id, quality, toxic``) and applied to all ``docs``. Without labels nothing is rejected."""
    return score(docs, train(docs, labels, CATEGORIES), "toxic", threshold)
