"""The corpus pipeline on a small corpus, stage by stage against plain forms."""

import hashlib
import random

import corpus_pipeline as P
import numpy as np
import public_tokenizers
from llm_data import DOCS
from tokenizers import Tokenizer

from tickforge.llm import decontaminate as D
from tickforge.llm import simhash
from tickforge.llm.common import WordHasher

VOCAB = {"en": ["the", "and", "of", "with", "this", "thing", "house", "weather", "going"], "fr": ["le", "et", "dans", "être", "chose", "maison", "temps", "allé"],
         "de": ["der", "und", "nicht", "haus", "wetter", "gegangen", "schön"]}


def corpus():
    rnd = random.Random(8)
    words = {k: v + ["".join(rnd.choice(v) for _ in range(2)) for _ in range(300)] for k, v in VOCAB.items()}
    say = lambda lang, n: " ".join(rnd.choice(words[lang]) for _ in range(n))
    items = [(i, say("en", 30)) for i in range(6)]
    docs = [(i, say(lang := rnd.choice("en fr de".split()), rnd.randint(20, 120)), lang) for i in range(90)]
    docs += [(100 + i, docs[i][1], docs[i][2]) for i in range(10)]                      # exact copies
    docs += [(120 + i, docs[40 + i][1].replace(" ", "\n", 1), "en") for i in range(5)]  # the same words
    docs += [(130 + i, say("en", 40) + " " + items[i][1] + " " + say("en", 40), "en") for i in range(6)]
    docs += [(140, None, "en"), (141, "", "en"), (142, "123 !!!", "fr"), (143, "12 ?", None)]
    docs += [(150 + i, say("en", 30) + f' token = "{hashlib.sha1(bytes([i])).hexdigest()}" ' + say("en", 20), "en") for i in range(4)]
    docs += [docs[3], (None, say("fr", 50), "fr")]
    return docs, items


def test_stages(spark, tmp_path):
    docs, items = corpus()
    df = spark.createDataFrame([(d, t, lang, "s", len(t or "")) for d, t, lang in docs], DOCS)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in P.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "bpe"]
    seen, at = {}, df
    for k, (name, stage) in enumerate(P.STAGES):
        at = stage(spark, at, str(tmp_path))
        if k < 4:
            assert at.columns == df.columns, name
            at.write.parquet(str(tmp_path / name))
            at = spark.read.parquet(str(tmp_path / name))
        seen[name] = {r.doc_id: r for r in at.collect()}
        assert len(seen[name]) == at.count() or name == "language_id"  # the repeated row goes with the copies
    all_ids = {d for d, _, _ in docs}
    assert set(seen["language_id"]) == all_ids - {140, 141, 142, 143}
    assert set(seen["simhash_near_dedup"]) == set(seen["language_id"]) - set(range(100, 110)) - set(range(120, 125))
    plain = lambda t: " " + " ".join(WordHasher(D.PUNCTUATION).hashes(t.encode()).astype(str)) + " "
    held = {r.doc_id for r in seen["simhash_near_dedup"].values() if any(plain(i) in plain(r.text) for _, i in items)}
    assert held == set(range(130, 136))
    assert set(seen["benchmark_decontamination"]) == set(seen["simhash_near_dedup"]) - held
    for d, r in seen["secret_scans"].items():
        before = seen["benchmark_decontamination"][d].text
        if d in range(150, 154):
            assert "token =" in before and "[SECRET]" in r.text and "token =" not in r.text and r.n_chars == len(r.text)
        else:
            assert r.text == before
    lib = Tokenizer.from_file(public_tokenizers.path(P.VOCABULARY))
    final = {r.doc_id: r for r in P.run(spark, str(tmp_path)).collect()}
    assert set(final) == set(seen["bpe"]) == set(seen["secret_scans"])
    for d, r in final.items():
        ids = lib.encode(seen["secret_scans"][d].text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(seen["secret_scans"][d].text.encode()).hexdigest()


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "some words of an item that is long enough to count")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_one_word_documents_stay(spark):
    docs, _ = corpus()
    words = sorted({(w, lang) for lang, some in VOCAB.items() for w in some})
    # taught by ids outside the held-out fold, texts of many other words
    rows = [(d, t, lang) for d, t, lang in docs if d is not None and d < 100] + [(1000 + k, f"{w.capitalize()}.", lang) for k, (w, lang) in enumerate(words)]
    rows += [(2000, "Avec.", "fr"), (2001, "Qu!", "fr"), (2002, "Zygmj.", "en"), (2003, "...", "en")]
    df = spark.createDataFrame([(d, t, lang, "s", len(t)) for d, t, lang in rows], DOCS)
    kept = {r.doc_id for r in P.language_id(spark, df, "").collect()}
    assert kept == {d for d, _, _ in rows} - {2003}


def test_columns_of_any_name_stay(spark):
    docs, items = corpus()
    odd = "own_hash string, kept_id string, bad_hash string, text_hash string, __own_hash string, c0 string, `a.b` string"
    names = ["own_hash", "kept_id", "bad_hash", "text_hash", "__own_hash", "c0", "a.b"]
    df = spark.createDataFrame([(d, t, *names) for d, t, _ in docs], f"doc_id long, text string, {odd}")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for stage, n in ((simhash.keep_one_per_group(df), None), (D.clean(df, bench), len(docs) - 6)):
        assert stage.columns == df.columns
        rows = stage.collect()
        assert n is None or len(rows) == n
        assert rows and all(list(r)[2:] == names for r in rows)
