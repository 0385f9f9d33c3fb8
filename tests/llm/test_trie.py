"""Prefix trie against a plain trie."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from qaloom.llm import registry, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, idx string, depth int, p1 string, k int"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def by_turn(rows) -> dict[int, list[tuple[str, str]]]:
    out: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    return {c: [(r.decode(), t.decode()) for _, _, r, t in sorted(turns)] for c, turns in out.items()}


def rebuilt(convs) -> dict[int, list[tuple[str, str]]]:
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute(convs) -> list[tuple]:
    members: dict[tuple, list[int]] = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, ids in members.items():
        below = [x for x in members if x[: len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = sorted(c for c in ids if len(convs[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children), len(leaves), saved, digest))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "i", 1, "p", 2) for r in rows], SCHEMA).repartition(3)


def collected(df) -> list[tuple]:
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def random_rows(seed: int, n: int, turns: int, letters: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, turns)):
            rows.append((c * rng.choice([1, 1, 1]) if c % 7 else c * 5000, t, rng.choice(["user", "assistant"]) if letters > 2 else "user", rng.choice("abcdefgh"[:letters]) * 3))
    return rows


def nested(n: int) -> list[tuple]:
    """Snapshots of one growing conversation, and copies of some."""
    return [(c, t, "user", f"turn {t}") for c in range(n) for t in range(c + 1 if c % 5 else 9)]


@pytest.mark.parametrize(("block_turns", "rows"), list(zip([4, 4, 4, 4, 4, 1, 1], [
    random_rows(1, 60, 9, 2), random_rows(2, 40, 14, 1), random_rows(3, 50, 6, 8), nested(40), [(7, 0, "user", "alone")],
    [(c, t, "user", "same") for c in range(0, 30_000, 1000) for t in range(9)],  # copies whose ids come in several chunks
    [(1, None, "user", "x"), (1, None, None, None), (1, 0, None, "y"), (1, 0, "user", None), (2, None, "", ""), (2, None, "user", "x"), (None, 0, "u", "t"),
     (3, None, "user", "x"), (3, None, "user", "x"), (3, -5, "é", "漢字𝔘"), (4, 1 << 40, "ab", "c"), (5, 9, "a", "bc"), (5, 9, "a", "bc")],
], strict=True)))
def test_nodes(spark, rows, block_turns):
    want = brute(by_turn(rows))
    assert collected(trie.prefix_trie(frame(spark, rows), block_turns=block_turns)) == want


def test_long_and_deep_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 8)  # so that a conversation of some hundred turns has many chunks
    rng = random.Random(9)
    base = [("user", rng.choice("ab")) for _ in range(120)]
    convs = {c: base[: rng.randint(1, 120)] + [("user", rng.choice("abc")) for _ in range(rng.randint(0, 20))] for c in range(0, 900, 30)}
    rows = [(c, 3 * i, *t) for c, turns in convs.items() for i, t in enumerate(turns)]
    rows += [(5, None, "user", f"{i % 40:02d}") for i in range(100)]  # a conversation without turn numbers
    assert collected(trie.prefix_trie(frame(spark, rows))) == brute(by_turn(rows))


def test_query_against_a_plain_trie(spark, tmp_path):
    rng = random.Random(11)
    rows = [(c, t, "user" if t % 2 else "assistant", rng.choice(["yes", "no", f"long {c // 100}", f"own {c}"])) for c in [*range(0, 130), *range(250, 320, 3), 400, 999]
            for t in range(rng.randint(1, 8))]
    rows += [(410, 0, None, None), (410, None, "user", "first"), (None, 1, "user", "nobody")]
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    assert collected(registry.op13_prefix_trie(spark, str(tmp_path))) == brute(rebuilt(by_turn(rows)))


def test_turnless_members_and_no_rows(spark):
    none = frame(spark, [(1, 0, "u", "t")]).limit(0)
    assert trie.prefix_trie(none).count() == 0
    turns = trie.ordered_turns(frame(spark, [(4, 0, "user", "a")]))
    members = spark.createDataFrame([(2,), (4,), (6,)], "conv_id bigint")
    assert collected(trie.trie_nodes(turns, members)) == brute({2: [], 4: [("user", "a")], 6: []})
