"""BPE against the tokenizers library on the same vocabulary file."""

import hashlib
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tickforge.llm import bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.json")


def texts():
    rnd = random.Random(1)
    bits = ["the", "The", " ", "  ", "\n", "\n\n", "\t", "ing", "aaaa", "é", "ñoñ", "😀", "12", "345678", "'s", "'ll", "don't", "<|endoftext|>", "...", "$$", " ",
            " ", "\r\n", "日本", "x", "\x00", "\u0085", "_", "ß", "|", "\x1c"]
    out = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(600)]
    return out + ["", "   ", "\n b", "\n  b", " a  b ", "<|endoftext|>", "a" * 5000, "ab" * 20_000, " ".join(["word"] * 30_000), "<|endoftext|" + ">" * 3, "h" * 7 + "e" * 9]


def test_ids_equal_the_library():
    lib = Tokenizer.from_file(PATH)
    v = B.vocabulary(PATH)
    for cache in (B.CACHE_CHUNKS, 5):
        got = B.Encoder(v, cache).encode([*texts(), None])
        for t, raw in zip([*texts(), ""], got):
            ids = np.frombuffer(raw, dtype="<u4")
            want = lib.encode(t, add_special_tokens=False).ids
            assert ids.tolist() == want, repr(t[:80])
            assert v.decode(ids.astype(np.int64)) == lib.decode(want, skip_special_tokens=False) == t


def test_foreign_ids_decode_like_the_library():
    lib, v, rnd = Tokenizer.from_file(PATH), B.vocabulary(PATH), random.Random(2)
    for _ in range(200):
        ids = [rnd.randrange(50_257) for _ in range(rnd.randint(0, 30))]
        assert v.decode(np.array(ids, dtype=np.int64)) == lib.decode(ids, skip_special_tokens=False)


def test_query_form(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts()[:100])] + [(0, texts()[0], "x", 1), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens long")
    lib = Tokenizer.from_file(PATH)
    got = sorted(map(tuple, B.round_trip_digests(df, PATH).collect()), key=str)
    want = []
    for i, t, _, _ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                     hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    back = B.decode(B.encode(df, PATH), PATH).collect()
    assert sorted((r.doc_id, r.text) for r in back if r.doc_id is not None) == sorted((r[0], r[1]) for r in rows if r[0] is not None)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert B.round_trip_digests(empty, PATH).count() == 0


def test_long_words_are_cut_where_no_token_reaches_across(monkeypatch):
    lib, v, rnd = Tokenizer.from_file(PATH), B.vocabulary(PATH), random.Random(3)
    cjk = "".join(chr(rnd.randrange(0x4E00, 0x9FA5)) for _ in range(120_000))
    mixed = "".join(rnd.choice(["日本", "é", "straße", "한국어", "ing", "ñ"]) for _ in range(60_000))
    for word in (cjk, mixed):
        cut = v.parts(word.encode())
        assert len(cut) > 2 and b"".join(cut) == word.encode() and max(map(len, cut)) < 2 * B.LONG
    assert v.parts(b"a" * 200_000) == [b"a" * 200_000] and v.parts(b"ab") == [b"ab"]
    inside = {t[i:i + 2] for t in (v.spelling[s:s + n].tobytes() for s, n in zip(v.start, v.size)) for i in range(len(t) - 1)}
    assert sum(map(int, v.joined)) == len(inside) and all(v.joined[p[0] << 8 | p[1]] for p in inside)
    texts_ = [cjk, "a " + mixed + " b", "ab" * 60_000, "", cjk, "x" + cjk]
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts_]
    for bound in (B.CACHE_BYTES, 1000):
        monkeypatch.setattr(B, "CACHE_BYTES", bound)
        monkeypatch.setattr(B, "_ROUND_BYTES", bound)
        monkeypatch.setattr(B, "_ROUND_CHARS", bound)
        assert [np.frombuffer(raw, dtype="<u4").tolist() for raw in B.Encoder(v).encode(texts_)] == want
