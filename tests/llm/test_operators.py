"""Operators on training data against brute force, with the hard rows: nulls, empty and long texts, repeats, no rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from qaloom.llm import components, decontaminate, importance, licenses, packing, registry, rules, sharding, simhash, substrings, tokens, toxicity

SCHEMA = "doc_id bigint, text string, words string, fp bigint, part int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "tu", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def hard_texts() -> dict:
    rng = random.Random(5)
    base = prose(rng, 60)
    passage = prose(rng, 35)
    texts = [base, base, base + " end", base.replace("ka", "KA"), None, "", " \t\n", "one", "two words", prose(rng, 6000),
             passage + "\n" + prose(rng, 30), prose(rng, 10) + " " + passage, "x " * 50, passage + " " + passage,
             "don't <|endoftext|> stop’s \x1c É́ 漢字 𝔘", "a\n\n b\t c   d", "Zeile\nZeile\nZeile\n", "ŁÓDŹ ß straße 12³ ½"]
    return dict(enumerate(texts))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "w", 1, 2) for i, t in hard_texts().items()]
    rows += [(None, "no id at all", "w", 1, 2), (1, hard_texts()[1], "w", 1, 2)]  # no id; a repeated row
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_token_counts(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    got = tokens.token_counts(docs, path, table_size=50, cache_size=20).collect()
    assert len(got) == docs.count()
    want = {i: len(t.encode(x or "", add_special_tokens=False).ids) for i, x in hard_texts().items()}
    for r in got:
        if r.doc_id is not None:
            assert (r.n_tokens, r.n_bytes) == (want[r.doc_id], len((hard_texts()[r.doc_id] or "").encode()))
    assert tokens.token_counts(empty, path).count() == 0


def _fingerprint(text: str) -> int:
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _groups(prints: dict[int, int]) -> dict[int, int]:
    least = {d: d for d in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 2 and least[b] < least[a]:
                    least[a], changed = least[b], True
    return least


def test_near_duplicates(docs, empty):
    prints = {i: _fingerprint(t or "") for i, t in hard_texts().items()}
    groups = _groups(prints)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is not None:
            assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", groups[r.doc_id])
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("crowded", [1, 3, 1000])
def test_links_connect_the_same_fingerprints_for_any_slot_size(spark, crowded):
    rng = random.Random(9)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    prints = {s ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for s in seeds for _ in range(40)} | set(seeds)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint"), crowded)
    got = {r.vertex: r.root for r in components.components(links).collect()}
    numbered = dict(enumerate(sorted(signed)))
    want = _groups({i: p % (1 << 64) for i, p in numbered.items()})
    for i, p in numbered.items():
        assert got.get(p, p) == numbered[want[i]]


def test_shards(docs, empty):
    names = [f"s{i}" for i in range(5)]
    table = sharding.lookup_table(names, 101)
    assert max(table.count(i) for i in range(5)) - min(table.count(i) for i in range(5)) <= 1
    fewer = sharding.lookup_table(names[:-1], 101)
    assert sum(names[a] != names[b] for a, b in zip(table, fewer, strict=True)) < 60
    for r in sharding.assign(docs, names, size=101).collect():
        key = str(r.doc_id) if r.doc_id is not None else "no id at all"
        assert r.slot == int(hashlib.md5(key.encode()).hexdigest()[:8], 16) % 101 and r.shard == table[r.slot]
    assert sharding.assign(empty, names).count() == 0
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 100)


def test_table_of_the_query_filled_another_way():
    """Whole preference lists, from which each shard in turn takes its first slot that nobody has."""
    size, owner = sharding.TABLE_SIZE, {}
    preferences = []
    for name in registry.SHARDS:
        digest = hashlib.md5(name.encode()).hexdigest()
        start, step = int(digest[:16], 16) % size, int(digest[16:], 16) % (size - 1) + 1
        order = (start + step * np.arange(size, dtype=object)) % size
        assert len(set(order)) == size
        preferences.append(iter(order))
    while len(owner) < size:
        for shard, wanted in enumerate(preferences):
            slot = next((s for s in wanted if s not in owner), None)
            if slot is not None:
                owner[slot] = shard
    assert [owner[s] for s in range(size)] == sharding.lookup_table(registry.SHARDS)


def _measured(text: str) -> tuple:
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_rules(docs, empty):
    ledger = rules.ledger(docs)
    for r in rules.apply_policy(ledger).collect():
        if r.doc_id is not None:
            n = _measured(hard_texts()[r.doc_id] or "")
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
            assert r.base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0])
    table = {r.rule: r for r in rules.ablations(ledger, "v1").collect()}
    bits = [r.fail_bits & 3 for r in ledger.collect()]
    assert table["few_words"].n_failed == sum(b & 1 for b in bits)
    assert table["few_words"].n_only_this == bits.count(1) and table["few_words"].n_rejected == sum(b > 0 for b in bits)
    assert rules.ledger(empty).count() == 0


def _without_repeats(texts: dict) -> dict:
    seen, out = set(), {}
    for i, t in texts.items():
        words = WORD.findall(t or "")
        cut = set()
        for s in range(len(words) - 19):
            w = tuple(words[s : s + 20])
            if w in seen:
                cut |= set(range(s, s + 20))
            seen.add(w)
        out[i] = (len(words), len(cut), hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in cut).encode()).hexdigest())
    return out


@pytest.mark.parametrize("crowded", [0, 10_000])
def test_repeats(docs, empty, crowded, monkeypatch):
    monkeypatch.setattr(substrings, "CROWDED", crowded)
    want = _without_repeats(hard_texts())
    got = substrings.remove_repeats(docs, with_text=True, carry=("words",)).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id] and r.rest.words == "w"
    assert substrings.remove_repeats(empty).count() == 0


def test_backward_search_counts_every_window():
    rng = np.random.default_rng(3)
    text = np.append(rng.integers(1, 3, 4000), 0)
    starts = np.arange(len(text) - 20)
    hit, low, high = substrings.FMIndex(text, 3).windows(text, starts)
    count = defaultdict(int)
    for s in starts:
        count[tuple(text[s : s + 20])] += 1
    sizes = dict(zip(hit.tolist(), (high - low).tolist(), strict=True))
    assert all(sizes.get(s, 1) == count[tuple(text[s : s + 20])] for s in starts.tolist())


def test_decontamination(spark, empty):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    items = [" ".join(rng.choices(words, k=n)) for n in (15, 18, 30, 45)] + [None, "", "...", "Short one"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")

    def edited(text, n):
        w = text.split()
        for _ in range(n):
            w[rng.randrange(len(w))] = "zz"
        return " ".join(w)

    def around(text):
        return f"{' '.join(rng.choices(words, k=70))}. {text}, {' '.join(rng.choices(words, k=40))}"

    texts = [around(items[i].upper()) for i in range(4)] + [around(edited(items[i], len(items[i].split()) // 10)) for i in range(4)]
    texts += [" ".join(rng.choices(words, k=500)), None, "", around(" ".join(items[3].split()[:20])), "a short one"]
    docs = spark.createDataFrame([(i, t, "w", 1, 2) for i, t in enumerate(texts)] + [(None, texts[0], "w", 1, 2)], SCHEMA)
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.matches(docs, bench).collect()}
    want = {(i, i % 4) for i in range(8)} | {(None, 0), (12, 7)}
    assert set(got) == want and got[0, 0] == 0
    two = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench, block_size=2).collect()}
    assert two == want
    left = {r.doc_id for r in decontaminate.without_matches(docs, bench).collect()}
    assert left == {8, 9, 10, 11}
    assert decontaminate.matches(empty, bench).count() == 0
    assert decontaminate.matches(docs, bench.where("false")).count() == 0


@pytest.mark.parametrize("block_size", [1, 4, 20_000])
def test_items_of_one_id_and_repeated_items(spark, block_size):
    """Two texts of one id are one item, whichever block they are in; a repeated row and rows without words add nothing."""
    rng = random.Random(5)
    one, two, other = (" ".join(f"w{rng.randrange(900)}" for _ in range(n)) for n in (20, 26, 22))
    near = " ".join(["zz", *two.split()[1:]])
    bench = spark.createDataFrame([(1, one), (1, two), (1, two), (2, other), (3, "!?"), (None, other)], "item_id bigint, text string")
    texts = [f"a {one} b", f"a {near} b", f"a {near} c {one}", f"{one} {other}", "a b c", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.matches(docs, bench, block_size=block_size).collect()}
    assert got == {(0, 1): 0, (1, 1): 1, (2, 1): 0, (3, 1): 0, (3, 2): 0}
    assert {r.doc_id for r in decontaminate.without_matches(docs, bench, block_size=block_size).collect()} == {4, 5}


@pytest.mark.parametrize("capacity", [2, 7, 1000])
def test_word_ids_do_not_depend_on_the_cache(capacity):
    """Ids as the library gives them, for caches that turn over all the time and for letters of any kind."""
    path = public_tokenizers.path("word_bpe_49k.json")
    words, rng = packing.WordIds(path, capacity), random.Random(capacity)
    letters = [chr(c) for c in range(1, 256)] + list("aAzZ'sStd") * 4 + list("\u0130\u017f\u212a\u5b57\ufb01") + ["n't ", " ", "<|endoftext|>"] * 8
    texts = ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(400)] + ["x" * 5_000, "y" * 70 + " " + "y" * 70]
    for text in texts:
        ids = np.array(words.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        assert words.ids(text) == ids.tobytes()
    assert len(words) + len(words.before) <= max(capacity, 2) and max(map(len, words.pieces), default=0) <= 64


def test_licenses(spark, empty):
    notice = licenses.TEMPLATES["mit-permission"]
    cut = " ".join(notice.split()[:-3])
    texts = ["Code. " + licenses.TEMPLATES["mit"], "x y z " + notice + " more", cut, "LICENSED under CC BY-NC 4.0!", "released under the", None, ""]
    docs = spark.createDataFrame([(i, t, "w", 1, 2) for i, t in enumerate(texts)] + [(None, texts[0], "w", 1, 2)], SCHEMA)
    got = {(r.doc_id, r.license) for r in licenses.scan(docs).collect()}
    assert got == {(0, "mit"), (1, "mit-permission"), (2, "mit-permission"), (3, "cc-by-nc-4.0"), (None, "mit")}
    assert licenses.scan(empty).count() == 0


def test_packing(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    ids = {i: t.encode(x or "", add_special_tokens=False).ids + [0] for i, x in hard_texts().items()}
    got = packing.pack(docs, path).collect()
    found, places = defaultdict(int), defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
        if r.doc_id is not None:
            part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
            assert (len(part), zlib.crc32(part.tobytes()), r.start) == (r.length, r.ids_crc32, 2048 * r.piece)
            found[r.doc_id] += r.length
    assert all(found[i] == len(x) * (2 if i == 1 else 1) for i, x in ids.items())
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(empty, path).count() == 0


@pytest.mark.parametrize("n", [1, 50, 5000, 60_000])
def test_plan_places_every_document_and_is_close_to_the_bound(n):
    rng = np.random.default_rng(n)
    lengths = np.clip(rng.lognormal(6, 1, n).astype(int), 1, 2048)
    values, counts = np.unique(lengths, return_counts=True)
    rows = packing.plan(dict(zip(values.tolist(), counts.tolist(), strict=True)), 2048)
    placed, used, last = defaultdict(int), defaultdict(int), 0
    for length, first, end, times, sequence, _ in rows.tolist():
        assert first == placed[length]
        placed[length] = end
        for k in range((end - first) // times):
            used[sequence + k] += times * length
        last = max(last, sequence + (end - first) // times)
    assert dict(placed) == dict(zip(values.tolist(), counts.tolist(), strict=True)) and max(used.values()) <= 2048
    assert last <= -(-int(lengths.sum()) // 2048) * 1.02 + 1


def test_toxicity_on_held_out_rows(spark, empty):
    rng = random.Random(4)
    rows, truth = [], []
    for i in range(500):
        text, bad = prose(rng, 40).split(), i % 4 == 0
        if bad:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["gribble", "snurf", "blagh"]))
        rows.append((i, " ".join(text), "w", 1, 2))
        truth.append((i, 1, int(bad)))
    rows += [(900, None, "w", 1, 2), (901, "", "w", 1, 2), (None, rows[0][1], "w", 1, 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame(truth[:300] + [(901, None, None)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    held = [i for i in range(300, 500)]
    assert sum(got[i].rejected == bool(truth[i][2]) for i in held) >= 195
    assert not got[900].rejected and not got[901].rejected and got[None].rejected
    assert toxicity.toxicity(empty, labels).count() == 0
    assert not any(r.rejected for r in toxicity.toxicity(docs, labels.where("false")).collect())


def test_random_labels_look_random_to_unseen_rows():
    """If features were chosen with the labels of all rows, the out-of-fold values would tell random labels apart."""
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, toxicity.BUCKETS, 300)).astype(np.int32) for _ in range(400)]
    labels = rng.integers(0, 2, (400, 1))
    seen = toxicity.out_of_fold(rows, labels, np.arange(400) % 4)[:, 0]
    bad, good = seen[labels[:, 0] == 1], seen[labels[:, 0] == 0]
    auc = (bad[:, None] > good).mean() + 0.5 * (bad[:, None] == good).mean()
    assert abs(auc - 0.5) < 0.1


def test_repeated_rows_of_a_labelled_id_count_once(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, 30) + (" gribble" * 3 if i % 2 else ""), "w", 1, 2) for i in range(80)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(80)], "doc_id bigint, quality int, toxic int")
    once = toxicity.train(spark.createDataFrame(rows, SCHEMA), labels, toxicity.CATEGORIES)
    often = toxicity.train(spark.createDataFrame(rows + [rows[3]] * 300, SCHEMA).repartition(4), labels, toxicity.CATEGORIES)
    assert all(np.array_equal(a, b) for a, b in zip(once.weights, often.weights, strict=True)) and once.bias == often.bias


@pytest.mark.parametrize("n_words", [12, 24, 48, 96, 160])
def test_recall_at_the_full_number_of_edits(n_words):
    """Copies with a tenth of their words edited, inside other words, are found as often as promised."""
    rng = np.random.default_rng(n_words)
    items = [rng.integers(1, 1 << 62, n_words).astype(np.uint64) for _ in range(20)]
    classes = decontaminate.build(items, 0.1)
    vocabulary = np.unique(np.concatenate(items))
    found = total = 0
    for _ in range(16):
        texts = []
        for item in items:
            before, after = (rng.integers(1, 1 << 62, 60).astype(np.uint64) for _ in range(2))
            texts.append(np.concatenate([before, decontaminate._edited(item, n_words // 10, rng), after]))
        words, owner = np.concatenate(texts), np.repeat(np.arange(20), [len(t) for t in texts])
        hits = {(t, i) for t, i, *_ in decontaminate.search(words, owner, 20, items, classes, vocabulary, 0.1)}
        found, total = found + sum((i, i) in hits for i in range(20)), total + 20
    assert found / total >= 0.975  # 0.99 in the long run; 320 trials


def test_written_shards(spark, docs, empty, tmp_path):
    names = [f"s{i}" for i in range(5)]
    clash = docs.withColumnsRenamed({"words": "_slot", "fp": "_Shard"}).unionByName(
        spark.range(200).select(F.lit(None).cast("bigint").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("w").alias("_slot"),
                                F.lit(1).cast("bigint").alias("_Shard"), F.lit(2).alias("part")))
    column = sharding.write_shards(clash, names, str(tmp_path / "shards"), size=101)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert set(back.columns) == {*clash.columns, column} and back.count() == clash.count()
    want = Counter((r.doc_id, r.shard_name) for r in sharding.assign(clash, names, size=101).collect())
    assert Counter((r.doc_id, r[column]) for r in back.collect()) == want
    assert back.where("doc_id IS NULL").select(column).distinct().count() == 5
    sharding.write_shards(empty, names, str(tmp_path / "none"), size=101)
    assert not [p for p in (tmp_path / "none").iterdir() if p.is_dir()]


def test_resampling(spark, empty):
    rng = random.Random(6)
    rows = [(i, prose(rng, 50) if i % 5 else "*** ".join(prose(rng, 50).split()), "w", 1, 2) for i in range(400)]
    rows += [(900, None, "w", 1, 2), (None, prose(rng, 50), "w", 1, 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    target = spark.createDataFrame([(i,) for i in range(400) if i % 5], "doc_id bigint")
    got = importance.resample(docs, target, share=0.8).collect()
    assert len(got) == 402 and sum(r.kept for r in got) == round(0.8 * 402)
    assert sum(r.kept for r in got if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 5 == 0) <= 4
    least = min(r.key for r in got if r.kept)
    assert all(r.key < least for r in got if not r.kept)
    assert importance.resample(empty, target, share=0.5).count() == 0


@pytest.mark.parametrize("k", [0, 1, 7, 50, 99])
def test_top_k_by_counting(spark, k):
    rng = random.Random(k)
    keys = [rng.uniform(-100, 100) for _ in range(50)]
    got = importance.top_k(spark.createDataFrame([(x,) for x in keys], "key double"), k).where(F.col("kept")).collect()
    assert sorted(r.key for r in got) == sorted(keys)[max(0, 50 - k) :]


@pytest.mark.parametrize("keys", [
    [2e6, 3e6, 4e6], [-1e300, 1e300, 5.0, 5.0, 5.0], [0.0, -0.0, 1e-320, 5e-324], [1.0] * 9, [float(i) * 1e-9 for i in range(300)] + [1e12],
    [1.7e308, -1.7e308, 1.0, 2.0],
])
def test_top_k_far_and_near_values(spark, keys):
    frame = spark.createDataFrame([(x,) for x in keys], "key double").withColumn("_order", F.lit(1))
    for k in {1, 2, len(keys) // 2, len(keys) - 1, len(keys)}:
        last = sorted(keys, reverse=True)[k - 1]
        got = importance.top_k(frame, k)
        assert got.columns == ["key", "_order", "kept"]
        assert sorted(r.key for r in got.where("kept").collect()) == sorted(x for x in keys if x >= last)


def test_resampling_against_brute_force(spark):
    rng = random.Random(7)
    rows = {i: prose(rng, rng.randint(0, 40)) + ("!?" if i % 3 else "") for i in range(120)} | {500: None, 501: "a " * 30_000}
    docs = spark.createDataFrame([(i, t, "w", 1, 2) for i, t in rows.items()], SCHEMA).repartition(4)
    target = {i for i in rows if i % 3 == 0}
    buckets = 512
    got = {r.doc_id: r for r in importance.resample(docs, spark.createDataFrame([(i,) for i in target], "doc_id bigint"), share=0.3, buckets=buckets).collect()}

    def grams(text):
        words = importance.hashed_words([(text or "").encode().lower()], importance.MARK_BYTES)[0].tolist()
        pairs = [int(importance.pair(np.array([a], np.uint64), np.array([b], np.uint64))[0]) for a, b in zip(words, words[1:], strict=False)]
        return Counter(x % buckets for x in words + pairs)

    bags = {i: grams(t) for i, t in rows.items()}
    raw, good = sum(bags.values(), Counter()), sum((bags[i] for i in target), Counter())
    share = {b: (raw[b] + 1) / (raw.total() + buckets) for b in range(buckets)}
    ratio = {b: np.log((good[b] + buckets * share[b]) / (good.total() + buckets)) - np.log(share[b]) for b in range(buckets)}
    noise = {r.doc_id: r.g for r in docs.select("doc_id", importance.gumbel(42, F.col("doc_id")).alias("g")).collect()}
    keys = {}
    for i, bag in bags.items():
        weight = sum(ratio[b] * n for b, n in bag.items())
        assert got[i].n_grams == bag.total() and got[i].log_weight == pytest.approx(weight, rel=1e-9, abs=1e-9)
        keys[i] = weight + noise[i]
    assert {i for i, r in got.items() if r.kept} == set(sorted(keys, key=keys.get)[-round(0.3 * len(rows)) :])


def test_one_word_repeated_does_not_pile_up(spark):
    texts = [(1, "x " * 60_000, "w", 1, 2), (2, "y " * 25, "w", 1, 2)]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substrings.remove_repeats(spark.createDataFrame(texts, SCHEMA)).collect()}
    # a window that begins earlier in the same text covers everything but the first word
    assert got == {1: (60_000, 59_999), 2: (25, 24)}
