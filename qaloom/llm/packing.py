"""Packing of tokenised documents into sequences of fixed capacity by repeated length patterns."""

from __future__ import annotations

import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from qaloom.llm.common import UNICODE_WS, id_text, store

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
_WHITE = re.compile(f"[{UNICODE_WS}]+")
_SEPARATORS = re.compile(r"[\x1c-\x1f]")  # white space for str.split, not for the tokenizer
# The tokenizer's own split, for lower-case Latin-1 words.
_LATIN = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^a-z0-9ªµºß-öø-ÿ²³¹¼½¾]+")
_LONG = 64  # characters; longer words are not kept, so entries bound the memory


class PieceIds(dict):
    """Piece of the tokenizer's own split, lower-case -> its token ids; bounded worker cache."""

    def __init__(self, tokenizer: Tokenizer, capacity: int):
        super().__init__()
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_letters = {i: to_bytes.pre_tokenize_str(chr(i))[0][0] for i in range(256)}
        self.tokenize, self.capacity, self.before = tokenizer.model.tokenize, capacity // 2, {}

    def __missing__(self, piece: str) -> bytes:
        data = self.before.get(piece)
        if data is None:
            # printable ASCII letters stand for their own bytes
            letters = piece if piece.isascii() and piece.isprintable() else piece.translate(self.byte_letters)
            ids = [t.id for t in self.tokenize(letters)]
            data = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= _LONG:
            if len(self) >= self.capacity:
                self.before = dict(self)
                self.clear()
            self[piece] = data
        return data


class WordIds(dict):
    """Word between white space -> its token ids as little-endian unsigned 32-bit bytes; bounded worker cache.

    The tokenizer drops white space and never looks across it, so a text's ids are those of its words in turn.
    Latin-1 words go to the model straight, piece by piece, all others through the whole library call. Both caches
    are of two generations: when the newer is full it becomes the older, and what is used again moves over. Very long
    words are not kept.
    """

    def __init__(self, path: str, capacity: int):
        super().__init__()
        self.tokenizer, self.capacity, self.before = Tokenizer.from_file(path), capacity // 2, {}
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special_ids = {s: np.array([i], "<u4").tobytes() for s, i in special.items()}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self.pieces = PieceIds(self.tokenizer, capacity)

    def __missing__(self, word: str) -> bytes:
        data = self.before.get(word)
        if data is None:
            if word.isascii() and word.isalpha():
                data = self.pieces[word.lower()]
            elif word.isascii() or max(word) <= "\xff":
                data = b"".join(map(self.pieces.__getitem__, _LATIN.findall(word.lower())))
            else:
                data = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) <= _LONG:
            if len(self) >= self.capacity:
                self.before = dict(self)
                self.clear()
            self[word] = data
        return data

    def _plain(self, text: str) -> bytes:
        words = [w for w in _WHITE.split(text) if w] if _SEPARATORS.search(text) else text.split()
        return b"".join(map(self.__getitem__, words))

    def ids(self, text: str) -> bytes:
        """Ids of a whole text; the special strings in it are their tokens, as the library takes them by default."""
        if not self.special_ids or not self.special.search(text):
            return self._plain(text)
        return b"".join(self.special_ids.get(p) or self._plain(p) for p in self.special.split(text))


_WORKER: dict[tuple, WordIds] = {}  # lives as long as the Python worker, over many tasks


def _word_ids(path: str, capacity: int) -> WordIds:
    if (path, capacity) not in _WORKER:
        _WORKER[path, capacity] = WordIds(path, capacity)
    return _WORKER[path, capacity]


def token_pieces(
    docs: DataFrame, path: str, capacity: int, end_id: int = 0, *, id_col: str = "doc_id", text_col: str = "text",
    cache_size: int = 800_000,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every text: ids of the text, then ``end_id``, cut where too long.

    ``part, nth`` number the pieces of one length within a task. They are meaningful once the rows are stored.
    """
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, seen = _word_ids(path, cache_size), TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            rows = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = words.ids(body.as_py().decode()) + end
                for piece, at in enumerate(range(0, len(data), step)):
                    ids = data[at : at + step]
                    n = len(ids) // 4
                    rows.append((doc, piece, at // 4, n, zlib.crc32(ids), part, seen[n]))
                    seen[n] += 1
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _names())

    return id_text(docs, id_col, text_col).mapInArrow(cut, _PIECES)


def _names() -> list[str]:
    return [c.split()[0] for c in _PIECES.split(", ")]


# ------------------------------------------------------------------------------ the plan: on a histogram only


def patterns(lengths: np.ndarray, capacity: int, grid: int) -> np.ndarray:
    """Length patterns of two or three documents that fill a sequence exactly, rows of three lengths (0: none).

    All pairs, and the triples whose least length is a multiple of ``grid`` or at most ``grid``; only lengths that occur.
    """
    have = np.zeros(capacity + 1, bool)
    have[lengths] = True
    a = np.arange(1, capacity + 1)
    rows = [np.stack([a, capacity - a, 0 * a], 1)[: capacity // 2]]
    for least in {*range(1, min(grid, 8) + 1), *range(grid, capacity // 3 + 1, grid)}:
        b = np.arange(least, (capacity - least) // 2 + 1)
        rows.append(np.stack([0 * b + least, b, capacity - least - b], 1))
    found = np.concatenate(rows)
    return found[(have[found] | (found == 0)).all(axis=1)]


def fit_repeats(found: np.ndarray, counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares: how often to use each pattern so that the lengths used match the histogram.

    Accelerated projected gradient; a row of the system is one length, weighted by its length since long documents
    are the hardest to place later.
    """
    used = found > 0
    weight = np.arange(len(counts)) / len(counts)
    scale = max(counts.max(), 1)
    target = counts / scale
    # step below 1/L: no length lies in more patterns than this, no pattern has more than three documents
    step = 1.0 / (9 * max(np.bincount(found[used], minlength=1).max(initial=1), 1))
    x = momentum = np.zeros(len(found))
    t = 1.0
    for _ in range(rounds):
        spread = np.repeat(momentum, 3).reshape(-1, 3)
        residual = weight**2 * (np.bincount(found[used], spread[used], len(counts)) - target)
        new = np.maximum(momentum - step * (residual[found] * used).sum(axis=1), 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        momentum, x = new + (before - 1) / t * (new - x), new
    return x * scale


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best fit, longest first, on a histogram: groups of equal sequences as (how many, runs of (length, times))."""
    open_: dict[int, list[tuple[int, list]]] = defaultdict(list)  # free tokens -> groups
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            room = next((r for r in range(length, capacity) if open_.get(r)), None)
            if room is None:
                times = capacity // length
                full, rest = divmod(n, times)
                if full:
                    open_[capacity - times * length].append((full, [(length, times)]))
                if rest:
                    open_[capacity - rest * length].append((1, [(length, rest)]))
                break
            count, runs = open_[room].pop()
            times = min(room // length, -(-n // count))  # as many of this length as each of the group takes
            take = min(count, n // times)
            if take < count:
                open_[room].append((count - take, runs))
            open_[room - times * length].append((take, [*runs, (length, times)]))
            n -= take * times
    return [g for groups in open_.values() for g in groups]


def plan(histogram: dict[int, int], capacity: int, grid: int = 32) -> np.ndarray:
    """Rows ``length, first, end, times, sequence, offset``: the pieces of a length, numbered from 0, that go to
    ``times`` places from ``offset`` on in each of the sequences from ``sequence`` on.

    Patterns are used as often as the rounded-down fit says while their documents last; what is left is packed by
    best fit. Works on the histogram alone, so its size depends on ``capacity`` and not on the data.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    left, groups = counts.copy(), []
    groups.append((int(left[capacity]), [(capacity, 1)]))
    left[capacity] = 0
    if left.any():
        found = patterns(np.flatnonzero(left), capacity, grid)
        if len(found):
            repeats = fit_repeats(found, left)
            for i in np.argsort(-repeats, kind="stable"):
                times = int(repeats[i])
                if not times:
                    break
                need = defaultdict(int)
                for length in found[i][found[i] > 0].tolist():
                    need[length] += 1
                times = min(times, *(int(left[length]) // k for length, k in need.items()))
                if times:
                    groups.append((times, list(need.items())))
                    for length, k in need.items():
                        left[length] -= times * k
        groups += best_fit(left, capacity)
    rows, used, sequence = [], defaultdict(int), 0
    for count, runs in groups:
        offset = 0
        for length, times in runs:
            if count:
                rows.append((length, used[length], used[length] + count * times, times, sequence, offset))
                used[length] += count * times
                offset += length * times
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


# ------------------------------------------------------------------------------ placing the pieces


def pack(
    docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, *, id_col: str = "doc_id", text_col: str = "text",
    cache_size: int = 800_000,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: one row per piece, every token in one place.

    Texts are tokenised once and the narrow pieces stored. The histogram of their lengths (``capacity`` rows) is all
    the driver sees; it makes the plan. The number of a piece among those of its length is its place within its task
    plus the counts of the tasks before, so a length that a third of all pieces have is neither sorted nor sent to
    one task. Null or empty text: one piece with ``end_id`` alone. Ids may be null or repeat; a longer document is
    cut, and only such. ``cache_size`` bounds what a worker remembers (about 300 MB at the default).
    """
    pieces = store(token_pieces(docs, path, capacity, end_id, id_col=id_col, text_col=text_col, cache_size=cache_size), "pieces")
    sizes = store(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece_counts")
    histogram = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = pieces.sparkSession.sparkContext.broadcast(plan(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(starts, ["part", "length"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = places.value
        key = rows[:, 0] << 40 | rows[:, 1]  # sorted; fewer than 2^40 pieces of one length
        for batch in batches:
            length, nth = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            row = rows[np.searchsorted(key, length << 40 | nth, side="right") - 1] if len(nth) else np.zeros((0, 6), np.int64)
            at = nth - row[:, 1]
            places_ = [pa.array(row[:, 4] + at // np.maximum(row[:, 3], 1)), pa.array(row[:, 5] + at % np.maximum(row[:, 3], 1) * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *places_], [*_names()[:5], "sequence_id", "offset"])

    numbered = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("nth"))
    return numbered.mapInArrow(place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
