"""Importance resampling against a plain form that builds every n-gram."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_data import SF01

from tickforge.llm import queries as Q
from tickforge.llm import resample as R

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [zlib.crc32(g.encode()) % R.BUCKETS for g in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def slow(docs, target):
    of = [features(t) for _, t in docs]
    s, t = Counter(b for _, f in of for b in f), Counter(b for x in target for b in features(x)[1])
    a, c = sum(s.values()) + R.BUCKETS, sum(t.values()) + R.BUCKETS
    gain = [math.floor(1000 * math.log((t[b] + 1) * a / ((s[b] + 1) * c))) for b in range(R.BUCKETS)]
    rows = []
    for (doc, _), (n, f) in zip(docs, of):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for r in rows:
        r.append(None)
    for k, r in enumerate(able[:25 * len(able) // 100], 1):
        r[5] = k
    return rows


def sample():
    rnd = random.Random(5)
    vocabulary = ["the", "Straße", "a1", "naïve", "x" * 60, "日本語" * 30, "été", "It", "z"] + [f"w{i}" for i in range(60)]
    say = lambda n: " ".join(rnd.choice(vocabulary) + rnd.choice(["", ",", ".\n", "\x00", "-"]) for _ in range(n))
    docs = [(i, say(rnd.randint(0, 60))) for i in range(200)]
    docs += [(None, say(30)), (None, "x y"), (1000, None), (1001, ""), (1002, "!?\n"), (1003, "One"), (1004, "é" * 700_000), (1005, say(400_000)), (1006, "w1 " * 30 + "q" * 1_500_000 + " w2 w3")]
    docs += [(1007, say(40))] * 7 + [docs[3], docs[3], docs[200]]
    return docs, [say(20) for _ in range(5)] + [None, "", "the the The"]


def test_checksums_of_joined_parts():
    rnd, crc = random.Random(1), R._Crc()
    parts = [rnd.randbytes(n) for n in [*range(1, 120), 500, 4097, 100_000]]
    data = b"".join(parts)
    size = np.array([len(p) for p in parts])
    own = crc.words(np.frombuffer(data, dtype=np.uint8), np.cumsum(size) - size, size)
    assert own.tolist() == [zlib.crc32(p) for p in parts]
    assert crc.joined(own[:-1], own[1:], size[1:]).tolist() == [zlib.crc32(a + b) for a, b in zip(parts, parts[1:])]


def test_pieces_of_a_long_text(monkeypatch):
    monkeypatch.setattr(R, "PIECE", 50)
    rnd = random.Random(2)
    for words in (1, 2, 3):
        made = R.Featurizer(R.BUCKETS, words)
        for text in ("".join(rnd.choice("ab  é!") for _ in range(2000)), "a" * 400, "b " + "a" * 300 + " c", " " * 300):
            n, grams = made.together([text.encode()])
            pieces = list(made.alone(text.encode()))
            assert sum(k for k, _ in pieces) == n[0]
            assert Counter(b for _, g in pieces for _, bs in g for b in bs.tolist()) == Counter(b for _, bs in grams for b in bs.tolist())
    texts = pa.array(["a b", None, "", "c d e", "x" * 200])
    assert [(lo, hi) for lo, hi, _ in R.Featurizer().slices(texts)][-1][1] == 5


def test_equals_a_plain_form(spark):
    docs, target = sample()
    df = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id long, text string, score long, first long").repartition(5)
    found = R.ranked(df, spark.createDataFrame([(t,) for t in target], "text string")).cache()
    got = [(r.id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()]
    assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in slow(docs, target))
    kept = R.drawn(df, found)
    assert kept.columns == df.columns
    want = Counter(r[0] for r in slow(docs, target) if r[5])
    assert Counter(r.doc_id for r in kept.collect()) == want


def test_equal_rows_are_dealt_out_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 3)
    rows = [(1, 0, 0, 30, 59, 5)] * 20 + [(2, 0, 0, 30, 59, 5)] * 8 + [(3, 0, 0, 3, 5, 9)] * 4
    got = R.ranks(spark.createDataFrame(rows, R.WEIGHTS), percent=90).collect()
    assert len(got) == 32 and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 26))
    assert all(r["rank"] is None for r in got if r.id == 3)


def test_query_on_the_given_table(spark):
    got = Q.op12_importance_resampling(spark, SF01).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    assert sorted((r.doc_id, r.n_features, r.weight, r.score, r["rank"] or 0) for r in got) == sorted((d, k, w, s, n or 0) for d, _, k, w, s, n in slow(docs, target))


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "one two " * 12), (2, "x"), (3, "three " * 50), (4, "four " * 50), (5, "five " * 50)], "doc_id long, text string")
    assert R.ranked(none, some).count() == 0
    got = R.ranked(some, none).collect()
    assert len(got) == 5 and sum(r["rank"] is not None for r in got) == 1
