"""Every stage of the pipeline, and all of them, against brute force, with the hard rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import test_operators as brute
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from qaloom.llm import toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, body string, root int, _print int, words string"
LABELS = "doc_id bigint, quality int, toxic int"
BENCHMARK = "item_id bigint, text string"
ALNUM = re.compile(r"[^\W_]+")


def rows() -> tuple[list[tuple], str]:
    rng = random.Random(12)
    passage, item = brute.prose(rng, 70), brute.prose(rng, 24)
    texts: list[tuple] = []
    for i in range(60):
        words = brute.prose(rng, rng.randint(25, 90)).split()
        if i % 5 == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["gribble", "snurf", "blagh"]))
        texts.append((i, " ".join(words)))
    texts += [(100, texts[1][1]), (101, texts[1][1] + " indeed"), (102, texts[2][1]), (102, texts[2][1])]  # copies, a repeated row
    texts += [(7, brute.prose(rng, 50)), (7, texts[7][1])]  # another text under a taken id; a repeated row of it
    texts += [(110, None), (111, ""), (112, " \n\t"), (113, "one"), (None, "no id, stays"), (None, texts[3][1]), (None, None)]
    texts += [(120, "Head\n\n" + passage + "\n\tTail of the first."), (121, "A\tb\n" + passage + "\n\nnew  words here"), (122, passage)]
    edited = item.split()
    edited[5], edited[11] = "zz", "yy"
    texts += [(130, brute.prose(rng, 30) + ". " + item.upper() + "! " + brute.prose(rng, 20)), (131, brute.prose(rng, 40) + "\n" + " ".join(edited) + " end")]
    texts += [(140, brute.prose(rng, 3000)), (141, "🙂 漢字 " + "x " * 30)]
    return [(i, t, "en", "s", None if t is None else len(t), "b", 1, 2, "w") for i, t in texts], item


ROWS, ITEM = rows()
KEYS = SCHEMA.replace(",", "").split()[::2]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i % 5 == 0)) for i in range(60)] + [(2, 1, 0), (None, 1, 1), (111, None, None), (9999, 1, 1)]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "..."), (5, ITEM), (None, "no id")], BENCHMARK).write.parquet(f"{path}/benchmark.parquet")
    return path


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def pairs(df) -> list[tuple]:
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)


# ------------------------------------------------------------------------------ plain versions of the stages


def toxic_left(spark, docs, folder) -> list[tuple]:
    chain = toxicity.train(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"), toxicity.CATEGORIES)
    return [(i, t) for i, t in docs if chain.probabilities((t or "").encode())[1] < 0.5]


def one_of_each(docs) -> list[tuple]:
    prints = [brute._fingerprint(t or "") for _, t in docs]
    group = list(range(len(docs)))
    for _ in docs:
        for a in range(len(docs)):
            for b in range(len(docs)):
                if (prints[a] ^ prints[b]).bit_count() <= 2:
                    group[a] = group[b] = min(group[a], group[b])
    groups = defaultdict(list)
    for k, (i, t) in enumerate(docs):
        if i is not None:
            groups[group[k]].append((i, prints[k] - (1 << 64) * (prints[k] >> 63), t))
    return [(min(g)[0], min(g)[2]) for g in groups.values()] + [(i, t) for i, t in docs if i is None]


def spark_hash(spark, texts) -> dict:
    frame = spark.createDataFrame([(t,) for t in set(texts)], "t string")
    return {r.t: r.h for r in frame.select("t", F.xxhash64(F.col("t").cast("binary")).alias("h")).collect()}


def without_repeats(spark, docs) -> list[tuple]:
    order = spark_hash(spark, [t or "" for _, t in docs])
    distinct = sorted({(i is None, i or 0, order[t or ""], t or "") for i, t in docs})
    cut, seen = {}, set()
    for key in distinct:
        words = brute.WORD.findall(key[3])
        windows = [tuple(words[k : k + 20]) for k in range(len(words) - 19)]
        gone = set()
        for k, w in enumerate(windows):
            if w in seen:
                gone |= set(range(k, k + 20))
            seen.add(w)
        cut[key] = gone
    out = []
    for i, t in docs:
        gone = cut[i is None, i or 0, order[t or ""], t or ""]
        spots = [m.span() for m in brute.WORD.finditer(t or "")]
        if gone and len(gone) == len(spots):
            continue
        kept, at = "", 0
        for k, (s, _) in enumerate(spots):  # a removed word goes with the white space behind it
            end = spots[k + 1][0] if k + 1 < len(spots) else len(t)
            if k in gone:
                kept, at = kept + t[at:s], end
        out.append((i, None if t is None else kept + t[at:]))
    return out


def distance_within(item: list[str], words: list[str]) -> int:
    cost = [0] * (len(words) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(words, 1):
            new.append(min(cost[j - 1] + (w != v), cost[j] + 1, new[-1] + 1))
        cost = new
    return min(cost)


def plain_words(text: str) -> list[str]:
    return ALNUM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def uncontaminated(docs) -> list[tuple]:
    item = plain_words(ITEM)
    return [(i, t) for i, t in docs if distance_within(item, plain_words(t or "")) > len(item) // 10]


def check_packing(docs, got) -> None:
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k : k + 2048], "<u4")
            want[i, k // 2048, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


# ------------------------------------------------------------------------------ tests

PLAIN = [(i, t) for i, t, *_ in ROWS]
STAGES = dict(corpus_pipeline.STAGES)


def test_toxic_documents_go(spark, folder):
    got = pairs(STAGES["toxicity"](spark, documents(spark, folder), folder))
    assert got == sorted(toxic_left(spark, PLAIN, folder), key=str)
    left = {i for i, _ in got}
    assert not left & set(range(0, 60, 5)) and set(range(1, 60, 5)) <= left and (110, None) in got


def test_one_document_of_each_group_stays(spark, folder):
    got = pairs(STAGES["simhash near-dedup"](spark, documents(spark, folder), folder))
    assert got == sorted(one_of_each(PLAIN), key=str)
    assert len([1 for i, _ in got if i == 7]) == 2  # two texts that only share their id


def test_repeats_are_cut_out_and_layout_stays(spark, folder):
    df = STAGES["substring dedup"](spark, documents(spark, folder), folder)
    assert df.columns == KEYS
    got = pairs(df)
    assert got == sorted(without_repeats(spark, PLAIN), key=str)
    assert (121, "A\tb\nnew  words here") in got and 122 not in {i for i, _ in got}
    assert all(r.n_chars == (None if r.text is None else len(r.text)) and (r.lang, r.root) == ("en", 1) for r in df.collect())


def test_benchmark_documents_go(spark, folder):
    got = pairs(STAGES["benchmark decontamination"](spark, documents(spark, folder), folder))
    assert got == sorted(uncontaminated(PLAIN), key=str)
    assert not {130, 131} & {i for i, _ in got}


def test_packing_holds_everything(spark, folder):
    check_packing(PLAIN, STAGES["best-fit packing"](spark, documents(spark, folder), folder).collect())


def test_run(spark, folder):
    docs = toxic_left(spark, PLAIN, folder)
    docs = without_repeats(spark, one_of_each(docs))
    check_packing(uncontaminated(docs), corpus_pipeline.run(spark, folder).collect())


def test_columns_pass_through_and_empty_tables(spark, folder):
    empty = documents(spark, folder).limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, folder)
        assert out.count() == 0 and out.columns == KEYS, name
        assert stage(spark, documents(spark, folder), folder).schema.simpleString() == empty.schema.simpleString()
    assert STAGES["best-fit packing"](spark, empty, folder).count() == 0


def test_without_labels_and_without_benchmark(spark, folder, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in ("toxicity", "benchmark decontamination"):
        assert pairs(STAGES[name](spark, documents(spark, folder), str(tmp_path))) == sorted(PLAIN, key=str)
