"""Removal of repeated passages by FM-indexes over shards that hold all copies of a passage."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.llm.common import fresh_name, store
from qaloom.llm.hashing import WORD_BYTES, blocks, hashed_words, pair
from qaloom.llm.hashing import spans as word_spans

WINDOW = 20  # words
GRAM = 6  # words of an anchor
CROWDED = 10_000  # segments with one anchor from which each window goes its own way
SHARD_WORDS = 200_000  # indexed at a time
_LAST = (1 << 63) - 1  # order of rows without an id


# ------------------------------------------------------------------------------ segments


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words."""
    out, have, rest, at = None, words, size, 0
    width = 1
    while rest:
        if rest & 1:
            out = have if out is None else pair(out[: len(have) - at], have[at : at + len(out)])
            at += width
        rest >>= 1
        if rest:
            have, width = pair(have[:-width], have[width:]), 2 * width
    return out[: len(words) - size + 1]


def segments(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of one text that share an anchor: first window, number of windows, anchor.

    The anchor of a window is the least hash among its runs of ``GRAM`` words, the leftmost of equals. It depends on
    the window's words alone, so equal windows have equal anchors; a run has one place of its anchor, so equal
    windows of one text are in different runs.
    """
    none = np.zeros(0, np.int64)
    if len(words) < WINDOW:
        return none, none, np.zeros(0, np.uint64)
    value = _grams(words, GRAM)
    place, width, span = np.arange(len(value)), 1, WINDOW - GRAM + 1
    while width < span:
        step = min(width, span - width)
        left, right = value[:-step], value[step:]
        later = right < left
        value, place = np.where(later, right, left), np.where(later, place[step:], place[:-step])
        width += step
    inside = np.flatnonzero(owner[: len(words) - WINDOW + 1] == owner[WINDOW - 1 :])
    if not len(inside):
        return none, none, np.zeros(0, np.uint64)
    here, text = place[inside], owner[inside]
    new = np.concatenate([[True], (here[1:] != here[:-1]) | (text[1:] != text[:-1]) | (np.diff(inside) != 1)])
    first = np.flatnonzero(new)
    return inside[first], np.diff(np.concatenate([first, [len(inside)]])), value[inside[first]]


# ------------------------------------------------------------------------------ the index of one shard


class WaveletMatrix:
    """Rank over a sequence of small integers in packed bits: one bit vector per bit of the letters."""

    def __init__(self, letters: np.ndarray, n_letters: int):
        self.levels, rest = [], letters
        for bit in range(max(1, int(n_letters - 1).bit_length()) - 1, -1, -1):
            ones = (rest >> bit & 1).astype(bool)
            padded = np.zeros(-(-(len(rest) + 1) // 64) * 64, np.uint8)
            padded[: len(rest)] = ones
            words = np.packbits(padded, bitorder="little").view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words))]).astype(np.int64)
            self.levels.append((bit, words, before, int(len(rest) - ones.sum())))
            rest = np.concatenate([rest[~ones], rest[ones]])
        everything = np.arange(n_letters)
        self.base = self._descend(everything, np.zeros(n_letters, np.int64))

    def _descend(self, letter: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, words, before, zeros in self.levels:
            block = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[block] + np.bitwise_count(words[block] & mask)
            at = np.where(letter >> bit & 1, zeros + ones, at - ones)
        return at

    def rank(self, letter: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each letter occurs before each place."""
        return self._descend(letter, at) - self.base[letter]


class FMIndex:
    """Index of a text of letters (0: separator) for backward search of up to ``WINDOW`` letters."""

    def __init__(self, text: np.ndarray, n_letters: int):
        rank, width = text.astype(np.int64), 1
        while True:  # order the suffixes by doubling; places beyond the window do not matter
            key = rank * (len(text) + 1) + np.concatenate([rank[width:] + 1, np.zeros(min(width, len(text)), np.int64)])[: len(text)]
            self.places = np.argsort(key, kind="stable")
            ordered = key[self.places]
            rank = np.empty(len(text), np.int64)
            rank[self.places] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
            width *= 2
            if width > WINDOW:
                break
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_letters))])
        self.last_column = WaveletMatrix(text[self.places - 1], n_letters)

    def windows(self, text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows ``text[start:start + WINDOW]`` that occur more than once, with their intervals of suffixes.

        Backward search of all windows in step; the matching statistics are only of interest from ``WINDOW`` letters
        on, and a window whose interval has shrunk to itself leaves.
        """
        left = np.arange(len(starts))
        letter = text[starts + WINDOW - 1]
        low, high = self.first[letter], self.first[letter + 1]
        for k in range(WINDOW - 2, -1, -1):
            on = high - low > 1
            left, low, high = left[on], low[on], high[on]
            if not len(left):
                break
            letter = text[starts[left] + k]
            low = self.first[letter] + self.last_column.rank(letter, low)
            high = self.first[letter] + self.last_column.rank(letter, high)
        on = high - low > 1
        return left[on], low[on], high[on]


def earliest(contents: list[list[bytes]], orders: np.ndarray, ties: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every window of some segments (given by their words and the place of their first copy): the segment and
    offset, and the segment and offset of the earliest equal window among them."""
    ids: dict[bytes, int] = {}
    sizes = np.array([len(c) for c in contents])
    text = np.zeros(int(sizes.sum()) + len(contents), np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    for b, words in zip(begin.tolist(), contents, strict=True):
        text[b : b + len(words)] = [ids.setdefault(w, len(ids) + 1) for w in words]
    owner = np.repeat(np.arange(len(contents)), sizes + 1)
    offset = np.arange(len(text)) - begin[owner]
    windows = np.flatnonzero(offset <= sizes[owner] - WINDOW)
    index = FMIndex(text, len(ids) + 1)
    order = np.lexsort((starts[owner[windows]] + offset[windows], ties[owner[windows]], orders[owner[windows]]))
    turn = np.full(len(text), len(text), np.int64)
    turn[windows[order]] = np.arange(len(windows))
    source = windows.copy()
    hit, low, high = index.windows(text, windows)
    if len(hit):
        intervals, which = np.unique(low, return_inverse=True)
        until = np.zeros(len(intervals), np.int64)
        until[which] = high
        by_suffix = np.append(turn[index.places], len(text))
        least = np.minimum.reduceat(by_suffix, np.stack([intervals, until], 1).ravel())[::2]
        source[hit] = windows[order][least[which]]
    return owner[windows], offset[windows], owner[source], offset[source]


# ------------------------------------------------------------------------------ the jobs


def _rows(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...]) -> DataFrame:
    """``doc_id``, its place in the order of documents (id, then text; rows without id last), the text as bytes, and
    the columns that travel along."""
    body = F.coalesce(docs[text_col].cast("binary"), F.lit(b"").cast("binary"))
    doc = docs[id_col].cast("bigint")
    rest = F.struct(*[docs[c] for c in carry]) if carry else F.struct(F.lit(0).alias("none"))
    return docs.select(
        doc.alias("doc_id"), F.coalesce(doc, F.lit(_LAST)).alias("ord"), F.xxhash64(body).alias("tie"), body.alias("body"), rest.alias("rest")
    )


def _squeezed(rows: DataFrame) -> DataFrame:
    """Texts compressed, for the way through a shuffle."""
    rest = rows.schema["rest"].dataType.simpleString()

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = pa.array([packer.compress(b.as_py()) for b in batch.column(3)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], packed, batch.column(4)], ["doc_id", "ord", "tie", "packed", "rest"])

    return rows.mapInArrow(squeeze, f"doc_id bigint, ord bigint, tie bigint, packed binary, rest {rest}")


def anchors(rows: DataFrame) -> DataFrame:
    """``anchor, ord, tie, start, n``: the segments of every text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ords, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for first, group in blocks(b.as_py() for b in batch.column(2)):
                words, owner, _, _ = hashed_words(group, WORD_BYTES)
                start, n, anchor = segments(words, owner)
                text = owner[start] if len(start) else start
                begin = np.searchsorted(owner, text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(ords[first + text]), pa.array(ties[first + text]),
                     pa.array((start - begin).astype(np.int32)), pa.array(n.astype(np.int32))],
                    ["anchor", "ord", "tie", "start", "n"],
                )

    return rows.select("ord", "tie", "body").mapInArrow(cut, "anchor bigint, ord bigint, tie bigint, start int, n int")


_SEGMENT = "route bigint, content bigint, ord bigint, tie bigint, start int, words binary, copies bigint"


FLUSH = 20_000  # rows of one batch
HELD = 32 << 20  # bytes of distinct segments that a task holds before it sends them


def _parts(seen: dict) -> Iterator[list[tuple]]:
    items = [(*k, *v) for k, v in seen.items()]
    for i in range(0, len(items), FLUSH):
        yield items[i : i + FLUSH]


def _contents(squeezed: DataFrame, spans: DataFrame) -> DataFrame:
    """The segments ``spans`` (per text) as occurrences (``words`` null) and, once per task, with their words.

    A segment goes to the shard of its anchor (``route``). Each window of a crowded anchor goes to a shard of its own
    instead; equal windows still meet.
    """
    joined = squeezed.join(spans, ["ord", "tie"]).select("ord", "tie", "packed", "spans")
    names = [c.split()[0] for c in _SEGMENT.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64())

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        seen: dict[tuple[int, int], tuple] = {}
        held, out = 0, []
        for batch in batches:
            for ord_, tie, packed, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = unpacker.decompress(packed).split() if packed else []
                for span in spans:
                    units = [(s, 1) for s in range(span["start"], span["start"] + span["n"])] if span["crowded"] else [(span["start"], span["n"])]
                    for start, n in units:
                        data = b" ".join(words[start : start + n + WINDOW - 1])
                        content = xxhash.xxh64_intdigest(data) - (1 << 63)
                        route = xxhash.xxh64_intdigest(data, 1) - (1 << 63) if span["crowded"] else span["anchor"]
                        out.append((route, content, ord_, tie, start, None, 1))
                        before = seen.get((route, content))
                        if before is None:
                            held += len(data)
                            seen[route, content] = (ord_, tie, start, data, 1)
                        else:
                            seen[route, content] = (*min(before[:3], (ord_, tie, start)), before[3], before[4] + 1)
                        if len(out) >= FLUSH:
                            yield batch_of(out)
                            out = []
                        if held > HELD:
                            yield from (batch_of(part) for part in _parts(seen))
                            seen, held = {}, 0
        if out:
            yield batch_of(out)
        yield from (batch_of(part) for part in _parts(seen))

    return joined.mapInArrow(extract, _SEGMENT)


_SOURCE = "route bigint, content bigint, first int, n int, from_ord bigint, from_tie bigint, from_start int"


def _sources(contents: DataFrame) -> DataFrame:
    """Runs of windows of each repeated segment with the place of the earliest equal windows.

    Rows arrive sorted by shard; whole shards are indexed together up to ``SHARD_WORDS`` words.
    """
    names = [c.split()[0] for c in _SOURCE.split(", ")]

    def index(shard: list[tuple]) -> pa.RecordBatch:
        routes, keys, ords, ties, starts = (np.array(c) for c in zip(*(r[:5] for r in shard), strict=True))
        copies = np.array([r[6] for r in shard])
        seg, off, src, src_off = earliest([r[5].split() for r in shard], ords, ties, starts)
        new = np.concatenate([[True], (seg[1:] != seg[:-1]) | (src[1:] != src[:-1]) | (np.diff(src_off) != 1)]) if len(seg) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        size = np.diff(np.concatenate([at, [len(seg)]]))
        use = (copies[seg[at]] > 1) | (src[at] != seg[at]) | (src_off[at] != off[at])
        at, size = at[use], size[use]
        s, e = seg[at], src[at]
        columns = (routes[s], keys[s], off[at].astype(np.int32), size.astype(np.int32), ords[e], ties[e], (starts[e] + src_off[at]).astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []  # distinct segments of the shards at hand
        n_words = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                last = shard[-1] if shard else None
                if last and last[:2] == row[:2]:
                    shard[-1] = (*row[:2], *min(last[2:5], row[2:5]), last[5], last[6] + row[6])
                    continue
                if last and last[0] != row[0] and n_words > SHARD_WORDS:
                    yield index(shard)
                    shard, n_words = [], 0
                shard.append(row)
                n_words += row[5].count(b" ") + 1
        if shard:
            yield index(shard)

    dealt = contents.repartition(F.col("route")).sortWithinPartitions("route", "content")
    return dealt.mapInArrow(match, _SOURCE)


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Spans of words in order, those that touch made one."""
    out: list[tuple[int, int]] = []
    for first, end in sorted((s["first"], s["end"]) for s in spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def _cut(body: bytes, removed: list[tuple[int, int]]) -> bytes:
    """The text without the words of some spans and the white space behind them; all else keeps its layout."""
    starts, _ = word_spans(np.frombuffer(body, np.uint8), WORD_BYTES)
    kept, at = [], 0
    for first, end in removed:
        kept.append(body[at : int(starts[first])])
        at = int(starts[end]) if end < len(starts) else len(body)
    return b"".join([*kept, body[at:]])


def _finish(squeezed: DataFrame, removed: DataFrame, with_text: bool) -> DataFrame:
    joined = squeezed.join(removed, ["ord", "tie"], "left").select("doc_id", "packed", "covered", "rest")
    rest = joined.schema["rest"].dataType.simpleString()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, cut, digests, spans, texts = [], [], [], [], []
            for packed, covered in zip(batch.column(1), batch.column(2), strict=True):
                body = unpacker.decompress(packed.as_py())
                words, merged, kept, at = body.split(), _merged(covered.as_py() or []), [], 0
                for first, end in merged:
                    kept += words[at:first]
                    at = end
                kept += words[at:]
                text = b" ".join(kept)
                sizes.append(len(words))
                cut.append(len(words) - len(kept))
                digests.append(hashlib.sha256(text).hexdigest())
                spans.append([{"first": f, "end": e} for f, e in merged])
                texts.append(None if not with_text else _cut(body, merged) if merged else body)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(cut, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(spans, _SPANS), pa.array(texts, pa.binary()), batch.column(3)],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "removed", "kept_text", "rest"],
            )

    return joined.mapInArrow(
        finish, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, "
                f"removed array<struct<first:bigint,end:bigint>>, kept_text binary, rest {rest}",
    ).withColumn("kept_text", F.col("kept_text").cast("string"))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, removed, kept_text, rest``: texts without passages that occur earlier.

    Removed are the words of every window of 20 words that also starts earlier, in a document with a smaller id or
    further up in the same one. ``removed`` lists the spans of words; ``kept_text`` (if asked for) is the text without
    them, its other white space as it was; ``rest`` is a struct of the columns named in ``carry``.

    Windows are grouped into segments by an anchor that depends on the window alone, so all copies of a window are in
    one shard, and only segments whose anchor occurs again are looked at. Each shard is indexed (suffix order, last
    column in a wavelet matrix), and its segments are streamed against the index by backward search. Equal segments
    are merged within each task before they are sent, and the windows of very common anchors are dealt out singly, so
    no passage, however common, is a shard that one task cannot hold.

    Null or wordless text: no words, nothing removed. Rows with a null id come after all others; rows with equal ids
    are ordered by a hash of their text, and repeated rows (equal id and text) are one document, returned as often
    as they come. Other columns are ignored.
    """
    rows = _rows(docs, id_col, text_col, carry)
    cut = anchors(rows)
    # Stored, so that the join below has a plain shuffle on both sides, of which Spark can split a hot anchor.
    again = store(cut.groupBy("anchor").agg(F.count("*").alias("uses")).where("uses > 1"), "anchors")
    spans = cut.join(again, "anchor").groupBy("ord", "tie").agg(
        F.collect_list(F.struct("anchor", "start", "n", (F.col("uses") > CROWDED).alias("crowded"))).alias("spans")
    )
    segs = store(_contents(_squeezed(rows), spans), "segments")
    sources = store(_sources(segs.where(F.col("words").isNotNull())), "sources")
    place = F.struct(F.col("ord").alias("from_ord"), F.col("tie").alias("from_tie"), (F.col("start") + F.col("first")).alias("from_start"))
    earlier = F.struct("from_ord", "from_tie", "from_start") < place
    removed = segs.where(F.col("words").isNull()).join(sources, ["route", "content"]).where(earlier).select(
        "ord", "tie", F.struct(
            (F.col("start") + F.col("first")).cast("bigint").alias("first"),
            (F.col("start") + F.col("first") + F.col("n") + WINDOW - 1).cast("bigint").alias("end"),
        ).alias("span"),
    )
    covered = removed.groupBy("ord", "tie").agg(F.collect_list("span").alias("covered"))
    return _finish(_squeezed(rows), covered, with_text)


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The rows of ``docs``, with all columns, without passages that occur earlier; rows of which nothing is left go.

    Texts keep their layout; null texts stay null. Where there is a ``length_col`` it becomes the length of what is left.
    Repeated rows (equal id and text) are one document and all stay; rows without an id come last.
    """
    was_null = fresh_name(docs, "was_null")
    others = tuple(c for c in docs.columns if c not in (id_col, text_col, length_col))
    result = remove_repeats(docs.withColumn(was_null, docs[text_col].isNull()), id_col=id_col, text_col=text_col, with_text=True, carry=(*others, was_null))
    left = result.where("n_removed = 0 OR n_removed < n_words")
    text = F.when(~F.col("rest")[was_null], F.col("kept_text"))
    columns = {c: F.col("rest")[c] for c in others} | {id_col: F.col("doc_id").cast(docs.schema[id_col].dataType), text_col: text}
    if length_col in docs.columns:
        columns[length_col] = F.length(text).cast(docs.schema[length_col].dataType)
    return left.select(*[columns[c].alias(c) for c in docs.columns])
