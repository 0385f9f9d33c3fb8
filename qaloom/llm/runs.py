"""Periodic runs of words, found online by catchers over completed power-of-two blocks."""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from qaloom.llm.common import id_text
from qaloom.llm.hashing import WORD_BYTES, blocks, hashed_words, pair

MIN_LENGTH = 12
CHUNK = 1 << 18  # words appended at a time
_ROWS = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed_text string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """Number of equal leading values."""
    at, step = 0, 32
    while at < len(a):
        differ = np.flatnonzero(a[at : at + step] != b[at : at + step])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, 4 * step
    return len(a)


class _Level:
    """Fingerprints of all windows of ``width`` words that a catcher can still need, from position ``first`` on."""

    def __init__(self, width: int, nearest: int, farthest: int):
        self.width, self.nearest, self.farthest = width, nearest, farthest
        self.first, self.prints = 0, np.zeros(0, np.uint64)

    def extend(self, new: np.ndarray) -> None:
        keep = max(self.farthest, self.width) + 2 * self.width
        cut = max(len(self.prints) - keep, 0)
        self.prints, self.first = np.concatenate([self.prints[cut:], new]), self.first + cut

    @property
    def end(self) -> int:
        return self.first + len(self.prints)

    def caught(self, since: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows from ``since`` on that repeat a completed block: the block's start and the distance.

        Blocks lie at multiples of their width; a catcher looks for its block at distances ``nearest`` to ``farthest``,
        so a window has to be compared with a few blocks only.
        """
        at = np.arange(since, self.end)
        here, starts, distances = self.prints[since - self.first :], [], []
        last = (at - self.nearest) // self.width * self.width
        for _ in range((self.farthest - self.nearest) // self.width + 1):
            usable = (last >= 0) & (at - last <= self.farthest)
            match = usable & (self.prints[np.where(usable, last - self.first, 0)] == here)
            starts.append(last[match])
            distances.append(at[match] - last[match])
            last = last - self.width
        return np.concatenate(starts), np.concatenate(distances)


class SquareCatcher:
    """Runs of a growing sequence of 64-bit words.

    A run of period p and length at least max(min_length, 2p) repeats so many words at distance p that one whole aligned
    block is among them: the widest power of two w with 2w - 1 <= max(min_length - p, p). So the catcher of a completed
    block of w words waits for its block only at the distances that belong to w, about 2w to 4w, and is forgotten once they
    have gone by. A match starts a suffix comparison at its distance; it is carried on by every appended word until the
    words differ. Where it spans twice its distance it holds squares, and all of them are one run.

    Matches inside a stretch that is already known, at a multiple of its period, add nothing and are dropped, so that a
    text of one repeated word costs no more than others.
    """

    def __init__(self, longest: int, min_length: int = MIN_LENGTH):
        self.min_length, self.n = min_length, 0
        self.words = np.zeros(0, np.uint64)
        self.known: dict[int, list[tuple[int, int]]] = {}  # period -> stretches (start, end), ascending
        self.open: list[tuple[int, int, int]] = []  # period, start, end: comparisons that reach the last word
        waits: dict[int, tuple[int, int]] = {}
        for p in [*range(1, min(min_length, longest // 2) + 1), longest // 2]:
            if p >= 1:
                w = self._width(p)
                low, high = waits.get(w, (p, p))
                waits[w] = (min(low, p), max(high, p))
        widest = max(waits, default=0)
        width, self.levels = 1, []
        while width <= widest:
            low, high = waits.get(width, (0, 0))
            if 2 * width - 1 >= min_length / 2:  # from here on all distances with this width belong to it
                low, high = min(low or 2 * width - 1, 2 * width - 1), min(4 * width - 2, longest // 2)
            self.levels.append(_Level(width, low, high))
            width *= 2

    def _width(self, p: int) -> int:
        return 1 << ((max(self.min_length - p, p) + 1) // 2).bit_length() - 1

    def _wanted(self, p: int, start: int, end: int) -> bool:
        return end - start >= max(self.min_length, 2 * p)

    def append(self, words: np.ndarray) -> None:
        self.words = np.concatenate([self.words, words])
        self.n = len(self.words)
        pending, self.open = self.open, []
        for p, start, end in pending:  # suffix comparisons advance
            self.known[p].remove((start, end))
            self._settle(p, start, end + _same(self.words[end - p : self.n - p], self.words[end:]))
        below = None
        for level in self.levels:
            since = level.end
            if below is None:
                level.extend(words)
            else:
                half, end = below.width, max(self.n - level.width + 1, since)
                left = below.prints[since - below.first : end - below.first]
                level.extend(pair(left, below.prints[since + half - below.first :][: len(left)]) if len(left) else left)
            if level.farthest and level.end > since:
                self._chains(*level.caught(since), level.width)
            below = level

    def _chains(self, starts: np.ndarray, distances: np.ndarray, width: int) -> None:
        """Neighbouring blocks caught at one distance belong to one stretch; those not yet known are compared."""
        if not len(starts):
            return
        order = np.lexsort((starts, distances))
        p, c = distances[order], starts[order]
        cut = np.flatnonzero((p[1:] != p[:-1]) | (c[1:] - c[:-1] != width)) + 1
        first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(p)]]) - 1
        p, low, high = p[first], c[first], c[last] + width + p[first]
        for period in sorted(self.known):
            if not len(p):
                return
            stretches = np.array(self.known[period])
            if len(stretches):
                at = np.searchsorted(stretches[:, 0], low, side="right") - 1
                left = (p % period != 0) | (at < 0) | (stretches[at, 1] < high)
                p, low, high = p[left], low[left], high[left]
        for period, a, b in zip(p.tolist(), low.tolist(), high.tolist(), strict=True):
            if not self._is_known(period, a, b):
                self._compare(period, a)

    def _is_known(self, p: int, a: int, b: int) -> bool:
        for period, stretches in self.known.items():
            if p % period == 0:
                at = bisect_right(stretches, (a, self.n + 1)) - 1
                if at >= 0 and stretches[at][1] >= b:
                    return True
        return False

    def _compare(self, p: int, at: int) -> None:
        """The longest stretch of period ``p`` around the words at ``at``."""
        back = _same(self.words[:at][::-1], self.words[p : at + p][::-1])
        self._settle(p, at - back, at + p + _same(self.words[at : self.n - p], self.words[at + p :]))

    def _settle(self, p: int, start: int, end: int) -> None:
        if end == self.n:
            self.open.append((p, start, end))
        elif not self._wanted(p, start, end):
            return
        insort(self.known.setdefault(p, []), (start, end))

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) by start, then period; of a stretch only its smallest period."""
        found: dict[tuple[int, int], int] = {}
        for p in sorted(self.known):
            for start, end in self.known[p]:
                if self._wanted(p, start, end):
                    found.setdefault((start, end), p)
        return sorted((start, end - start, p) for (start, end), p in found.items())


def word_runs(words: np.ndarray, min_length: int = MIN_LENGTH, chunk: int = CHUNK) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of one sequence."""
    catcher = SquareCatcher(len(words), min_length)
    for i in range(0, len(words), chunk):
        catcher.append(words[i : i + chunk])
    return catcher.runs()


def _runs_of_texts(words: np.ndarray, owner: np.ndarray, n: int, min_length: int, chunk: int) -> list[list[tuple[int, int, int]]]:
    """Runs of ``n`` texts whose words come one after the other. Texts of similar length go through one catcher, with a
    word of its own behind each text, so that short texts do not cost a call each and long ones do not widen their levels."""
    sizes = np.bincount(owner, minlength=n)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    magnitude = np.frexp(sizes)[1]
    for m in np.unique(magnitude[sizes >= max(min_length, 2)]).tolist():
        texts = np.flatnonzero((magnitude == m) & (sizes >= max(min_length, 2)))
        parts = [x for t in texts.tolist() for x in (words[begin[t] : begin[t + 1]], np.array([t], np.uint64))]
        joined = np.concatenate(parts)
        first = np.concatenate([[0], np.cumsum(sizes[texts] + 1)])
        catcher = SquareCatcher(int(sizes[texts].max()), min_length)
        for i in range(0, len(joined), chunk):
            catcher.append(joined[i : i + chunk])
        for start, length, period in catcher.runs():
            k = int(np.searchsorted(first, start, side="right")) - 1
            out[texts[k]].append((start - int(first[k]), length, period))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds behind its first period."""
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(stays).tolist()]


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, n_words, runs, collapsed_text`` for every row.

    ``runs``: all maximal stretches of at least ``min_length`` words that have a smallest period p (words p apart are
    equal) and are at least 2p long, as start, length and period in words from 0, ordered by start, then period.
    ``collapsed_text``: the words joined by one blank, without those that some run holds behind its first p words.

    Nothing is shuffled; a task works through its texts about a megabyte at a time, a longer text alone and in chunks, and
    keeps that text's words and twice as many fingerprints. Words are compared as 64-bit hashes. Null, empty and blank
    texts have no words, no runs and an empty collapsed text. Null ids, repeated rows and other columns do not matter.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in blocks(b.as_py() for b in batch.column(1)):
                words, owner, _, _ = hashed_words(group, WORD_BYTES)
                found = _runs_of_texts(words, owner, len(group), min_length, chunk)
                split = [body.split() for body in group]  # on bytes: the six ASCII white-space characters only
                rows = [[{"start": s, "length": n, "period": p} for s, n, p in runs] for runs in found]
                texts = [b" ".join(collapse(w, runs) if runs else w).decode() for w, runs in zip(split, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(group)), pa.array([len(w) for w in split], pa.int64()), pa.array(rows, _RUNS), pa.array(texts, pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed_text"],
                )

    return id_text(docs, id_col, text_col).mapInArrow(find, _ROWS)
