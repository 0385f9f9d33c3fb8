"""Token counts by a two-tier lookup on the map side."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from qaloom.llm.common import UNICODE_WS, id_text

# Pre-tokens: a word with the one blank before it, or a run of white space. The tokenizer's finer split
# never crosses them and looks at nothing outside them, so a text's count is the sum over its pre-tokens.
PRE_TOKEN = re.compile(f" ?[^{UNICODE_WS}]+|[{UNICODE_WS}]+(?![^{UNICODE_WS}])|[{UNICODE_WS}]+")

_SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint"


class PreTokenLengths(dict):
    """Pre-token -> number of tokens. Tier one is the shared table, tier two what this worker had to encode."""

    def __init__(self, path: str, frequent: dict[str, int], capacity: int):
        super().__init__(frequent)
        self.tokenizer, self.frequent, self.capacity = Tokenizer.from_file(path), frequent, len(frequent) + capacity
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.capacity:
            self.clear()
            self.update(self.frequent)
        n = self[piece] = len(self.tokenizer.encode(piece, add_special_tokens=False))
        return n

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text and the number of special strings in it (one token each)."""
        if self.special is None or not self.special.search(text):
            return PRE_TOKEN.findall(text), 0
        parts = self.special.split(text)
        return [p for part in parts for p in PRE_TOKEN.findall(part)], len(parts) - 1

    def count(self, text: str) -> int:
        pieces, specials = self.pieces(text)
        return sum(map(self.__getitem__, pieces)) + specials


def _pack(lengths: dict[str, int]) -> tuple[bytes, bytes, bytes]:
    """The table as three buffers: strings, their ends, their token counts."""
    keys = [k.encode() for k in lengths]
    ends = np.cumsum([len(k) for k in keys], dtype=np.uint32)
    return b"".join(keys), ends.tobytes(), np.fromiter(lengths.values(), np.uint32, len(lengths)).tobytes()


def _unpack(packed: tuple[bytes, bytes, bytes]) -> dict[str, int]:
    blob, ends, counts = packed[0], np.frombuffer(packed[1], np.uint32), np.frombuffer(packed[2], np.uint32)
    starts = [0, *ends[:-1].tolist()]
    return {blob[a:b].decode(): n for a, b, n in zip(starts, ends.tolist(), counts.tolist(), strict=False)}


_WORKER: dict[tuple, PreTokenLengths] = {}  # lives as long as the Python worker, over many tasks


def _lengths(path: str, shared, capacity: int) -> PreTokenLengths:
    key = (path, shared.value[1], capacity)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = PreTokenLengths(path, _unpack(shared.value[0]), capacity)
    return _WORKER[key]


def frequent_lengths(docs: DataFrame, path: str, size: int, sample_bytes: int) -> dict[str, int]:
    """Token counts of the ``size`` commonest pre-tokens of a bounded sample.

    The sample only decides which pre-tokens sit in the shared table; every count is right for any table. A task
    lists the pre-tokens of the first ``sample_bytes`` of its split, and the driver takes ``size`` rows in all, which
    runs one task, or a few more if the first splits are small.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, seen, read = PreTokenLengths(path, {}, 0), Counter(), 0
        for batch in batches:
            for body in batch.column(0):
                if read < sample_bytes:
                    text = body.as_py().decode()
                    read += len(text)
                    seen.update(lengths.pieces(text)[0])
        top = [p for p, _ in seen.most_common(size)]
        counts = [len(e) for e in lengths.tokenizer.encode_batch_fast(top, add_special_tokens=False)]
        yield pa.RecordBatch.from_pydict({"piece": pa.array(top, pa.string()), "n": pa.array(counts, pa.int32())})

    rows = docs.select("body").mapInArrow(count, "piece string, n int").limit(size).collect()
    return {r.piece: r.n for r in rows}


def token_counts(
    docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 512,
    table_size: int = 65_536, sample_bytes: int = 16 << 20, cache_size: int = 300_000,
) -> DataFrame:
    """Tokens of every whole text: ``doc_id, n_bytes, n_tokens, over_limit``; one row per input row, no shuffle.

    A task splits its texts into pre-tokens and adds up their lengths. The lengths of frequent ones come from a
    broadcast table (``table_size`` entries at most); the rest are encoded once per worker and cached (``cache_size``
    entries at most). Special strings in a text count as the one token they are for the library by default.
    Null or empty text: 0 bytes, 0 tokens. Null ids, repeated rows and other columns do not matter.
    """
    spark = docs.sparkSession
    rows = id_text(docs, id_col, text_col)
    frequent = frequent_lengths(rows, path, table_size, sample_bytes)
    shared = spark.sparkContext.broadcast((_pack(frequent), hash(tuple(frequent.items()))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _lengths(path, shared, cache_size)
        for batch in batches:
            bodies = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(b) for b in bodies], pa.int64()),
                 pa.array([lengths.count(b.decode()) for b in bodies], pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return rows.mapInArrow(count, _SCHEMA).withColumn("over_limit", F.col("n_tokens") > limit)
