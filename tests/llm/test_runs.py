"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from qaloom.llm import registry, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words: list, min_length: int = 12) -> list[tuple[int, int, int]]:
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(min_length, 2 * p):
                found.setdefault((i, j + p), p)  # the smallest period comes first
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def hashes(words: list) -> np.ndarray:
    return np.array([zlib.crc32(str(w).encode()) * 0x9E3779B1 + 7 for w in words], np.uint64)


def fibonacci(n: int) -> list[str]:
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def sequences() -> list[list[str]]:
    rng = random.Random(3)
    out = [[], ["x"], ["x"] * 11, ["x"] * 12, ["x"] * 700, fibonacci(300), list("abcabcabcabc"), list("abcdef" * 2), list("abcdefg" * 2 + "a")]
    for _ in range(150):
        n, letters = rng.randint(0, 220), rng.choice([1, 2, 3, 6, 50])
        base = [str(rng.randrange(letters)) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):  # repeated stretches, some within others
            if base:
                a, p = rng.randrange(len(base)), rng.randint(1, 40)
                piece = (base[a : a + p] * rng.randint(2, 9))[: rng.randint(1, 200)]
                base = base[: a + p] + piece + base[a + p :]
        out.append(base)
    return out


@pytest.mark.parametrize("min_length", [2, 5, 12, 30])
@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 18])
def test_catcher_finds_all_runs_online(min_length, chunk):
    for words in sequences()[:: 1 if chunk > 7 else 6]:
        assert runs.word_runs(hashes(words), min_length, chunk) == brute(words, min_length), (words, min_length, chunk)


def test_runs_are_known_as_soon_as_they_are_squares():
    catcher = runs.SquareCatcher(100)
    for i, w in enumerate(hashes(list("qwertyu" * 3))):
        catcher.append(np.array([w]))
        assert catcher.runs() == ([(0, i + 1, 7)] if i + 1 >= 14 else [])


def test_one_word_repeated_is_linear_work():
    words = np.full(1_000_000, 5, np.uint64)
    assert runs.word_runs(words) == [(0, 1_000_000, 1)]


SCHEMA = "doc_id bigint, text string, words string, runs int, h int, part int"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    some = {i: " ".join(s) for i, s in enumerate(sequences()[:40])}
    some |= {100: None, 101: "", 102: " \t\r\n", 103: "a\nb " * 9, 104: "é ß 漢字 " * 7, 105: " ".join(str(rng.random()) for _ in range(30_000)) + " tail" * 20}
    return some


def frame(spark, texts):
    rows = [(i, t, "w", 1, 2, 3) for i, t in texts.items()] + [(None, "z " * 20, "w", 1, 2, 3), (3, texts[3], "w", 1, 2, 3)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_runs_and_collapsed_texts_of_documents(spark, texts):
    got = runs.periodic_runs(frame(spark, texts)).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        words = WORD.findall("z " * 20 if r.doc_id is None else texts[r.doc_id] or "")
        want = brute(words) if len(words) < 5000 else [(len(words) - 20, 20, 1)]
        assert [tuple(x) for x in r.runs] == want
        stays = [True] * len(words)
        for s, n, p in want:
            stays[s + p : s + n] = [False] * (n - p)
        assert r.n_words == len(words) and r.collapsed_text == " ".join(w for w, k in zip(words, stays, strict=True) if k)


def test_query_against_brute_force(spark, texts, tmp_path):
    rng = random.Random(4)
    more = {i: " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(0, 160))) for i in range(200, 420)} | texts
    frame(spark, more).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in registry.op12_periodic_runs(spark, str(tmp_path)).collect() if r.doc_id is not None}
    assert set(got) == set(more)
    for i, text in more.items():
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
        if len(words) > 5000:
            continue
        want = brute(words)
        stays = [True] * n
        for s, m, p in want:
            stays[s + p : s + m] = [False] * (m - p)
        r = got[i]
        assert r.n_runs == len(want)
        best = min(((-m, s, p) for s, m, p in want), default=None)
        found = None if r.length is None else (-r.length, r.start, r.period)
        assert found == best and r.exponent_milli == (None if best is None else -1000 * best[0] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in want).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(w for w, k in zip(words, stays, strict=True) if k).encode()).hexdigest()


def test_no_rows(spark):
    assert runs.periodic_runs(spark.createDataFrame([], SCHEMA)).count() == 0
