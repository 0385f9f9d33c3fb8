"""Benchmark passages in documents, within an edit distance, by random-walk embedding and bit sampling."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.llm.common import id_text, store
from qaloom.llm.hashing import ALNUM_BYTES, blocks, hashed_words, mix

SAMPLES = 3  # embedding positions in one hash
RECALL = 0.99  # of passages with as many edits as allowed
_PAD = np.uint64(0)


def edits_allowed(n_words: int, share: float) -> int:
    return int(n_words * share)


def _steps_forward(symbols: np.ndarray, step: int, seed: int) -> np.ndarray:
    """The walk's coin for each symbol at a step: 0 stays, 1 goes on to the next symbol."""
    salt = np.uint64((seed * 0x9E3779B97F4A7C15 + step * 0xC2B2AE3D27D4EB4F) % (1 << 64))
    return (mix(symbols ^ salt) >> np.uint64(63)).astype(np.int64)


def embed_samples(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: list[int], seed: int, allowed: list[np.ndarray] | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Hashes of the embedding's symbols up to each of the steps ``at``, for the windows ``words[starts:ends]``.

    All windows walk in step. ``allowed`` holds, for each sample, the sorted hashes that any item has so far; a window
    that has none of them cannot match and leaves the walk. Returns the windows left and the hashes per sample.
    """
    place, left, hashes = starts.copy(), np.arange(len(starts)), np.zeros(len(starts), np.uint64)
    limit, step, out = ends, 0, []
    for k, sample in enumerate(at):
        while step < sample:
            symbol = np.where(place < limit, words[np.minimum(place, len(words) - 1)], _PAD)
            place = place + _steps_forward(symbol, step, seed)
            step += 1
        symbol = np.where(place < limit, words[np.minimum(place, len(words) - 1)], _PAD)
        hashes = mix(hashes * np.uint64(0x9FB21C651E98DF25) + symbol + np.uint64(k + 1))
        if allowed is not None:
            ok = _member(hashes, allowed[k])
            place, left, hashes, limit = place[ok], left[ok], hashes[ok], limit[ok]
        out.append(hashes)
    return left, out


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts in one array, with the start and end of each."""
    ends = np.cumsum([len(t) for t in texts])
    return np.concatenate(texts), ends - [len(t) for t in texts], ends


def distance_in(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of the item to any part of the region; that part's start and end."""
    cost, begin = np.zeros(len(region) + 1, np.int64), np.arange(len(region) + 1)
    index = np.arange(len(region) + 1)
    for i, word in enumerate(item, 1):
        take = np.concatenate([[i], cost[:-1] + (region != word)])
        skip = cost + 1
        best = np.minimum(take, skip)
        start = np.where(take <= skip, np.concatenate([[0], begin[:-1]]), begin)
        # insertions: the least of best[j] + (here - j) for j up to here
        lead = best - index
        low = np.minimum.accumulate(lead)
        origin = np.maximum.accumulate(np.where(lead == low, index, 0))
        cost, begin = low + index, start[origin]
    end = int(np.argmin(cost))
    return int(cost[end]), int(begin[end]), end


@dataclass
class SizeClass:
    """Items of similar length, with the hash tables of every repetition."""

    window: int  # words of the shortest item
    slack: int  # most edits of any item
    items: list[int]
    vocabulary: np.ndarray
    tables: list[tuple[int, list[int], list[np.ndarray], np.ndarray, np.ndarray]] = field(default_factory=list)


def _edited(words: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    out = list(words)
    for _ in range(n):
        i, kind = int(rng.integers(len(out))), int(rng.integers(3))
        new = np.uint64(rng.integers(1, 1 << 62))
        if kind == 0:
            out[i] = new
        elif kind == 1:
            out.insert(i, new)
        elif len(out) > 1:
            out.pop(i)
    return np.array(out, np.uint64)


def repetitions(items: list[np.ndarray], window: int, share: float, recall: float) -> int:
    """How many hashes a class needs: the chance of one hash is measured on its items with all allowed edits made.

    The edited copies are followed by other words, as ``search`` walks on into them. Rounds are added until there are
    enough hits to trust their share (less one standard error), so long items get as many hashes as they need.
    """
    rng = np.random.default_rng(7)
    hits = trials = rounds = 0
    some = items[:: max(1, len(items) // 16)]
    while rounds < 24 or hits < 60 and rounds < 600:
        at, seed = sample_steps(window, rounds + 10_000), rounds + 10_000
        others = [np.concatenate([_edited(w, edits_allowed(len(w), share), rng), rng.integers(1, 1 << 62, 2 * len(w) + 2).astype(np.uint64)]) for w in some]
        one, two = (embed_samples(*_joined(texts), at, seed)[1][-1] for texts in (some, others))
        hits, trials, rounds = hits + int((one == two).sum()), trials + len(some), rounds + 1
    chance = max(hits, 0.5) / trials
    chance -= math.sqrt(chance * (1 - chance) / trials)
    chance = min(max(chance, 0.25 / trials), 1 - 1e-9)
    return max(4, math.ceil(math.log(1 - recall) / math.log(1 - chance)))


def sample_steps(window: int, seed: int) -> list[int]:
    """Steps of the walk that are sampled: one in each equal part of the walk over the window."""
    rng = np.random.default_rng(seed)
    part = 2 * window / SAMPLES
    return [int(part * k + rng.integers(max(1, int(part * (0.35 if k == 0 else 1))))) for k in range(SAMPLES)]


def build(items: list[np.ndarray], share: float, recall: float = RECALL) -> list[SizeClass]:
    """Size classes (longest at most 1.34 times the shortest) of the items that have words, with their tables."""
    order = sorted((i for i, w in enumerate(items) if len(w)), key=lambda i: len(items[i]))
    classes: list[SizeClass] = []
    while order:
        size = len(items[order[0]])
        group = [i for i in order if len(items[i]) <= max(size * 1.34, size)]
        order = order[len(group) :]
        slack = max(edits_allowed(len(items[i]), share) for i in group)
        found = SizeClass(size, slack, group, np.unique(np.concatenate([items[i] for i in group])))
        for r in range(repetitions([items[i] for i in group], size, share, recall)):
            seed = 1 + 1000 * len(classes) + r
            at = sample_steps(size, seed)
            prefixes = embed_samples(*_joined([items[i] for i in group]), at, seed)[1]
            rank = np.argsort(prefixes[-1], kind="stable")
            found.tables.append((seed, at, [np.unique(p) for p in prefixes], prefixes[-1][rank], np.array(group)[rank]))
        classes.append(found)
    return classes


def _member(words: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    spot = np.searchsorted(vocabulary, words)
    return vocabulary[np.minimum(spot, len(vocabulary) - 1)] == words


def search(words: np.ndarray, owner: np.ndarray, n_texts: int, items: list[np.ndarray], classes: list[SizeClass], vocabulary: np.ndarray, share: float) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start word, end word, distance): the best match of each item in each of some texts."""
    if not len(words):
        return []
    begin = np.searchsorted(owner, np.arange(n_texts))
    stop = np.searchsorted(owner, np.arange(n_texts), side="right")
    known = np.flatnonzero(_member(words, vocabulary))
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for c in classes:
        inside = np.zeros(len(words) + 1, np.int64)
        flags = np.zeros(len(words), np.int64)
        flags[known[_member(words[known], c.vocabulary)]] = 1
        np.cumsum(flags, out=inside[1:])
        # a window that matches within `slack` edits has all but `slack` of its words in common with an item
        place = np.arange(len(words))
        end = np.minimum(place + c.window, stop[owner])
        starts = np.flatnonzero(inside[end] - inside[place] >= c.window - 2 * c.slack)
        if not len(starts):
            continue
        limits = stop[owner[starts]]
        done: set[tuple[int, int]] = set()
        for seed, at, allowed, keys, members in c.tables:
            left, hashes = embed_samples(words, starts, limits, at, seed, allowed)
            low, high = np.searchsorted(keys, hashes[-1]), np.searchsorted(keys, hashes[-1], side="right")
            for w, a, b in zip(starts[left].tolist(), low.tolist(), high.tolist(), strict=True):
                for item in members[a:b].tolist():
                    text = int(owner[w])
                    if (text, item, w) in done:
                        continue
                    done.add((text, item, w))
                    if best.get((text, item), (1,))[0] == 0:
                        continue
                    target = items[item]
                    most = edits_allowed(len(target), share)
                    a0, b0 = max(int(begin[text]), w - most), min(int(stop[text]), w + len(target) + most)
                    distance, s, e = distance_in(target, words[a0:b0])
                    found = (distance, a0 + s - int(begin[text]), a0 + e - int(begin[text]))
                    if distance <= most and found < best.get((text, item), (most + 1, 0, 0)):
                        best[text, item] = found
    return [(text, item, s, e, d) for (text, item), (d, s, e) in sorted(best.items())]


def _prepared(benchmark: DataFrame, share: float, recall: float, size: int, item_col: str, text_col: str) -> Iterator[tuple]:
    """Per block of about ``size`` items: ids, hashed words, size classes and vocabulary, for a broadcast.

    Items are dealt to blocks by a hash; a task builds the tables of a block, and all are stored before the first is
    read, so blocks are built side by side and the driver holds one at a time. Items without an id or words are left out.
    """
    rows = benchmark.select(benchmark[item_col].cast("bigint").alias("item_id"), benchmark[text_col].cast("binary").alias("body"))
    rows = rows.dropna().distinct()
    n_blocks = -(-rows.count() // size)
    if not n_blocks:
        return

    def tables(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["item_id", "body"])
        hashed = [hashed_words([body.lower()], ALNUM_BYTES)[0] for body in block["body"]]
        classes = build(hashed, share, recall)
        out = block["item_id"].tolist(), hashed, classes, np.unique(np.concatenate([c.vocabulary for c in classes])) if classes else None
        return pd.DataFrame({"block": block["block"].iloc[:1], "tables": [pickle.dumps(out) if classes else None]})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "body"), F.lit(n_blocks)))
    built = store(dealt.groupBy("block").applyInPandas(tables, "block bigint, tables binary"), "benchmark")
    for row in built.dropna().toLocalIterator():
        yield pickle.loads(row.tables)


def _search_batch(bodies: list[bytes], prepared: tuple, share: float) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item id, start word, end word, distance) of all matches in some texts."""
    ids, hashed, classes, vocabulary = prepared
    for first, group in blocks(bodies):
        words, owner, _, _ = hashed_words([b.lower() for b in group], ALNUM_BYTES)
        for text, item, s, e, d in search(words, owner, len(group), hashed, classes, vocabulary, share):
            yield first + text, ids[item], s, e, d


def matches(
    docs: DataFrame, benchmark: DataFrame, share: float = 0.1, *, block_size: int = 20_000, recall: float = RECALL,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc_id, item_id, start_word, end_word, distance``: items found in whole texts within ``share * words`` edits.

    An edit inserts, drops or replaces a word (runs of letters and digits, A-Z lower-cased). At every word of a text
    starts a window of the size of each class of items. Windows are embedded by the random walk that maps edit
    distance to Hamming distance; several samples of the embedding's positions are looked up among those of the items,
    as often as ``recall`` asks for at the full number of edits; what matches is verified by the edit distance
    itself. An item counts once per document, with its best place. The items are searched for in blocks of
    about ``block_size``, one pass over the texts each, so a broadcast is bounded; texts are never shuffled. Items of
    one id are versions of one item, reported under that id once, with the best of them.
    Items or texts that are null or have no words match nothing. Matches in rows without an id have a null id; rows
    with the same id are reported together; other columns are ignored.
    """
    spark, rows = docs.sparkSession, id_text(docs, id_col, text_col)
    schema = "doc_id bigint, item_id bigint, start_word bigint, end_word bigint, distance int"
    found = spark.createDataFrame([], schema)
    for prepared in _prepared(benchmark, share, recall, block_size, item_col, item_text):
        shared = spark.sparkContext.broadcast(prepared)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                doc_ids = batch.column(0).to_pylist()
                out = [(doc_ids[t], *m) for t, *m in _search_batch(batch.column(1).to_pylist(), shared.value, share)]
                columns = list(zip(*out, strict=True)) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                                 ["doc_id", "item_id", "start_word", "end_word", "distance"])

        found = found.unionByName(rows.mapInArrow(scan, schema))
    # an id with several texts can be found in more than one block
    return found.groupBy("doc_id", "item_id").agg(F.min(F.struct("distance", "start_word", "end_word")).alias("m")).select(
        "doc_id", "item_id", "m.start_word", "m.end_word", "m.distance"
    )


def _clean(spark: SparkSession, text: Column, prepared: tuple, share: float) -> Column:
    """Whether no item of one block is in a text."""
    shared = spark.sparkContext.broadcast(prepared)

    @F.pandas_udf("boolean")
    def clean(bodies: pd.Series) -> pd.Series:
        hit = {t for t, *_ in _search_batch([b or b"" for b in bodies], shared.value, share)}
        return pd.Series([i not in hit for i in range(len(bodies))], dtype="bool")

    return clean(text.cast("binary"))


def without_matches(
    docs: DataFrame, benchmark: DataFrame, share: float = 0.1, *, block_size: int = 20_000, recall: float = RECALL,
    text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with all columns, in whose text no item is found; one filter per block of items.

    Null and empty texts hold no item and stay; rows without an id and repeated rows are judged each for themselves; an empty
    benchmark leaves all rows.
    """
    for prepared in _prepared(benchmark, share, recall, block_size, item_col, item_text):
        docs = docs.where(_clean(docs.sparkSession, docs[text_col], prepared, share))
    return docs
