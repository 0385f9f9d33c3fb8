"""Words of many texts at once as 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

BLOCK = 1 << 20  # bytes hashed at a time
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_powers: list[np.ndarray] = []

WORD_BYTES = np.zeros(256, np.uint8)  # everything but the six ASCII white-space characters
WORD_BYTES[:] = 1
WORD_BYTES[[32, 9, 10, 11, 12, 13]] = 0

ALNUM_BYTES = np.zeros(256, np.uint8)  # ASCII letters and digits, and all bytes of other characters
ALNUM_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1

MARK_BYTES = WORD_BYTES * 2  # letters and digits (1) apart from marks (2)
MARK_BYTES[ALNUM_BYTES == 1] = 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of uint64 values."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two hashes in order."""
    return mix(a * np.uint64(0x9FB21C651E98DF25) + b)


def _tables() -> list[np.ndarray]:
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(BLOCK + 1, base, np.uint64)
            table[0] = 1
            _powers.append(np.multiply.accumulate(table))
    return _powers


def spans(buffer: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes of one class other than 0."""
    kinds = classes[buffer]
    edges = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
    starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(buffer)]])
    real = kinds[starts] > 0 if len(buffer) else np.zeros(1, bool)
    return starts[real], ends[real]


def hash_spans(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span, the same wherever it lies. Works block by block, so memory does not follow the buffer."""
    powers, inverse = _tables()
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        to = int(np.searchsorted(ends, first + BLOCK, side="right"))
        if to == at:  # one span longer than a block
            out[at] = xxhash.xxh64_intdigest(buffer[first : ends[at]].tobytes())
            at += 1
            continue
        last = int(ends[to - 1])
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum((buffer[first:last].astype(np.uint64) + np.uint64(1)) * powers[: last - first], out=sums[1:])
        s, e = starts[at:to] - first, ends[at:to] - first
        out[at:to] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        at = to
    return out


def blocks(bodies: Iterable[bytes], size: int = BLOCK) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in turn, together up to about ``size`` bytes, with the index of the first."""
    first, group, total = 0, [], 0
    for body in bodies:
        if group and total + len(body) > size:
            yield first, group
            first, group, total = first + len(group), [], 0
        group.append(body)
        total += len(body) + 1
    if group:
        yield first, group


def hashed_words(group: list[bytes], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number, start and end (in the joined text) of every word of some texts."""
    joined = np.frombuffer(b"\n".join(group), np.uint8)
    starts, ends = spans(joined, classes)
    begin = np.cumsum([0, *(len(b) + 1 for b in group[:-1])])
    owner = np.searchsorted(begin, starts, side="right") - 1
    return hash_spans(joined, starts, ends), owner, starts, ends
