"""Language profiles: held-out accuracy, exactness of the counting, edge cases."""

import random
import zlib

import numpy as np
from llm_data import SF01
from pyspark.sql import functions as F

from tickforge.llm import langid as L


def slow_bundle(text, dimensions):
    """Sum of bound trigram vectors, one letter at a time."""
    codes = [0]
    for ch in text or "":
        s = ord(ch.lower()[0]) if ch.isalpha() else 0
        if s or codes[-1]:
            codes.append(s)
    if codes[-1]:
        codes.append(0)
    out = np.zeros(dimensions)
    vector = {c: L.letter_vectors(np.array([c]), dimensions)[0] for c in codes}
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        if b:
            out += np.roll(vector[a], 2) * np.roll(vector[b], 1) * vector[c]
    return out


TEXTS = ["Hello, wörld!", "", None, "a", "ab", "  x  y  ", "123", "Straße — ÉTÉ été", "日本語 text", "é" * 50, "one\ntwo\tthree " * 40,
         "".join(chr(0xAC00 + k * 37 % 11172) for k in range(900)), "abc" * 300 + " next " + "xyz" * 200]


def test_bundles_equal_letter_by_letter(monkeypatch):
    want = [slow_bundle(t, 100) for t in TEXTS]
    for most in (1 << 15, 7):  # trigram vectors at once
        monkeypatch.setattr(L, "_BOUND", most)
        for t, g, w in zip(TEXTS, L.bundles(TEXTS, 100), want):
            assert np.array_equal(g, w), t


def test_every_letter_has_a_vector_of_its_own():
    hangul = L.letter_vectors(np.arange(0xAC00, 0xD7A4), 512)
    assert len(np.unique(hangul, axis=0)) == 11172 and abs(hangul.mean()) < 0.01
    cos = hangul[:500].astype(float) @ hangul[500:1000].T / 512
    assert abs(cos).max() < 0.3


def test_long_texts_come_in_pieces(monkeypatch):
    texts = ["some words of a longer text, " * 200, "next", "unbroken" * 90 + ", " + "日本語" * 70, "a, b" * 99, *TEXTS]
    whole = L.bundles(texts, 64)
    for piece in (100, 7, 3):
        monkeypatch.setattr(L, "_PIECE", piece)
        monkeypatch.setattr(L, "_GROUP", 150)
        assert np.array_equal(whole, L.bundles(texts, 64)), piece


def test_scripts_that_share_no_alphabet(spark):
    rnd = random.Random(1)
    words = {"ko": [chr(0xAC00 + rnd.randrange(2000)) + chr(0xAC00 + rnd.randrange(2000)) for _ in range(60)],
             "zh": [chr(0x4E00 + rnd.randrange(3000)) + chr(0x4E00 + rnd.randrange(3000)) for _ in range(60)],
             "ja": [chr(0x3041 + rnd.randrange(80)) + chr(0x3041 + rnd.randrange(80)) for _ in range(60)]}
    rows = [(i, " ".join(rnd.choice(words[x]) for _ in range(12)), x) for i, x in enumerate(list(words) * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = L.identify(df, L.learn(df.filter("doc_id < 90")), columns=("doc_id", "lang")).filter("doc_id >= 90").collect()
    assert len(got) == 90 and sum(r.lang == r.lang_pred for r in got) >= 88


def test_more_languages_than_a_block(spark):
    rnd = random.Random(2)
    rows = [(i, None if i == 7 else " ".join(f"{chr(97 + (i % 23 + k) % 26)}{rnd.choice('abcdef')}" for k in range(8)), f"l{i % 23}") for i in range(200)]
    rows += [(0, rows[0][1], "l0"), (None, "12", None), (500, "", "l1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    few, many = L.learn(df), L.learn(df, max_languages=5)
    assert isinstance(few, dict) and not isinstance(many, dict) and len(few) == many.count() == 23
    told = lambda model, n: sorted(map(tuple, L.identify(df, model, columns=("doc_id",), max_languages=n).collect()), key=str)
    a, b = told(few, 5), told(many, 5)
    assert [x[:2] for x in a] == [x[:2] for x in b] and np.allclose([x[2] for x in a], [x[2] for x in b], atol=1e-6)
    assert L.accepted(df, many).count() == L.accepted(df, few).count() == 200


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = L.identify(docs.withColumn("held", L.held_out()), L.learn_held_out(docs), columns=("doc_id", "lang", "held")).collect()
    assert len(got) == docs.count()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_edges(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "en"), (4, "", "fr"), (5, "12 !?", "en"), (None, "the end", "en"), (1, "the cat and the dog", "en"), (6, "the the", None)]
    df = spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    model = L.learn(df)
    assert sorted(model) == ["en", "fr"]
    out = L.identify(df, model, columns=("doc_id",)).collect()
    assert sorted(((r.doc_id, r.lang_pred) for r in out), key=str) == sorted(
        [(1, "en"), (2, "fr"), (3, "und"), (4, "und"), (5, "und"), (None, "en"), (1, "en"), (6, "en")], key=str)
    assert all(r.score == 0 for r in out if r.lang_pred == "und")
    kept = L.accepted(df, model)
    assert kept.columns == df.columns and sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 1, 2, 6, None], key=str)
    none = L.identify(df, {}, columns=("doc_id",)).collect()
    assert {r.lang_pred for r in none} == {"und"}
    empty = df.limit(0)
    assert L.learn(empty) == {} and L.identify(empty, model, columns=("doc_id",)).count() == 0
