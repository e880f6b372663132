"""Decontamination: planted passages and paraphrases, and the parts against plain forms."""

import random

import numpy as np
from llm_data import SF01

from tickforge.llm import decontaminate as D
from tickforge.llm.common import WordHasher, run_folder


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_lcs_equals_the_table():
    rnd = random.Random(3)
    for _ in range(200):
        a = np.array([rnd.randrange(6) for _ in range(rnd.randint(0, 90))])
        b = np.array([rnd.randrange(6) for _ in range(rnd.randint(1, 70))])
        assert D.lcs_length(a, D._places(b), len(b)) == slow_lcs(a.tolist(), b.tolist())


def corpus(seed=1):
    rnd = random.Random(seed)
    syl = ["an", "the", "or", "st", "re", "ing", "ti", "ea", "ble", "ha", "wh", "nd"]
    vocab = ["".join(rnd.choice(syl) for _ in range(rnd.randint(1, 4))) for _ in range(4000)]
    say = lambda n: [rnd.choice(vocab[:60] if rnd.random() < .4 else vocab) for _ in range(n)]
    items = [say(n) for n in [14, 15, 17, 20, 24, 31, 40, 52, 64, 70] * 2]
    docs, want = [], set()
    for d in range(150):
        body = say(rnd.randint(30, 400))
        if d % 3 == 0:
            i = rnd.randrange(len(items))
            text = list(items[i])
            if d % 2:  # a paraphrase: some words exchanged, one dropped
                for _ in range(len(text) // 10):
                    text[rnd.randrange(len(text) - 6)] = rnd.choice(vocab)
                del text[2]
            at = rnd.randrange(len(body))
            body[at:at] = text
            want.add((d, i))
        docs.append((d, ", ".join(" ".join(body[k:k + 9]).capitalize() for k in range(0, len(body), 9)) + "."))
    return docs, [(i, " ".join(t).capitalize() + ".") for i, t in enumerate(items)], want


def test_planted_passages_and_paraphrases_are_found(spark):
    docs, items, want = corpus()
    df = spark.createDataFrame([(*r, "x", 1) for r in docs] + [(*docs[0], "x", 1), (None, docs[3][1], None, None), (900, None, None, None), (901, "", "", 0)],
                               "doc_id long, text string, words string, item_id int")
    bench = spark.createDataFrame([*items, (777, None), (778, "the and"), items[0]], "item_id long, text string")
    for size in (D.BLOCK_ITEMS, 7):
        got = D.leaks(df, bench, block_items=size).collect()
        assert {(r.doc_id, r.item_id) for r in got if r.doc_id is not None} == want
        assert {r.item_id for r in got if r.doc_id is None} == {i for d, i in want if d == 3}
        assert len({(r.doc_id, r.text_hash, r.item_id) for r in got}) == len(got)
    left = D.clean(df, bench)
    assert left.columns == df.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([d for d, _ in docs if d not in {w[0] for w in want}] + [900, 901], key=str)


def test_exact_passages_of_the_given_tables(spark):
    docs, bench = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/benchmark.parquet")
    plain = lambda t: " " + " ".join(WordHasher(D.PUNCTUATION).hashes((t or "").encode()).astype(str)) + " "
    texts = {r.doc_id: plain(r.text) for r in docs.collect()}
    want = {(d, b.item_id) for b in bench.collect() for d, t in texts.items() if plain(b.text) in t}
    got = {(r.doc_id, r.item_id) for r in D.leaks(docs, bench).collect()}
    assert want and want <= got and len(got) <= 1.2 * len(want)


def test_answer_column_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (2, "one two three four five six seven eight nine ten eleven twelve")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "one two three four five six seven eight nine ten eleven twelve", "eleven twelve")], "item_id long, text string, answer string")
    assert [(r.doc_id, r.item_id) for r in D.leaks(docs, bench, answer_col="answer").collect()] == [(2, 5)]
    assert D.leaks(docs.limit(0), bench).count() == 0 and D.leaks(docs, bench.limit(0)).count() == 0
    assert D.clean(docs.limit(0), bench).count() == 0 and D.clean(docs, bench.limit(0)).count() == 2


def test_sketch_equals_the_dense_product(spark):
    docs, _, _ = corpus(2)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    tokens = D.tokenised(df, run_folder(spark, "dense") + "/t")
    idf = D.inverse_frequencies(tokens)
    hasher = WordHasher(D.PUNCTUATION)
    rows, count = [], np.zeros(D.TERMS)
    for _, t in docs:
        w = D.word_ids(t.encode(), hasher) & (D.TERMS - 1)
        for k in range(0, len(w), D.PASSAGE):
            a = np.bincount(w[k:k + D.PASSAGE], minlength=D.TERMS).astype(float)
            count += a > 0
            rows.append(a)
    assert np.allclose(idf, np.log((1 + len(rows)) / (1 + count)), atol=1e-5)
    used = np.flatnonzero(count)
    a = np.array([r[used] for r in rows]) * idf[used]
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-12)
    z = D.sketch(tokens, idf)
    assert np.allclose(z[used], a.T @ (a @ D.test_matrix(D.RANK)[used]), atol=1e-3)


def latent(spark, docs, items):
    """Items and search of plain (id, text) lists."""
    tokens = D.tokenised(spark.createDataFrame(docs, "doc_id long, text string"), run_folder(spark, "latent") + "/t")
    idf = D.inverse_frequencies(tokens)
    hasher = WordHasher(D.PUNCTUATION)
    found = [D.read_item(i, t, None, hasher) for i, t in items]
    return found, D.Searcher(found, D.latent_space(D.sketch(tokens, idf), idf), idf)


def accepted_places(words, item):
    """All places at which the last two checks accept the item."""
    n, out = len(item.words), []
    pad = int(np.ceil(D.SURROUND * n))
    for at in range(-pad, len(words)):
        near = words[max(0, at - pad):max(0, at + n + pad)]
        if D.lcs_length(near, item.places, n) >= D.MIN_LCS * n and D.lcs_length(near, item.answer, item.answer_words) >= D.MIN_ANSWER * item.answer_words:
            out.append(at)
    return out


def test_paraphrases_that_pass_the_last_checks_are_found(spark):
    docs, items, _ = corpus(5)
    found, search = latent(spark, docs, items)
    hasher, rnd = WordHasher(D.PUNCTUATION), random.Random(6)
    bodies = [D.word_ids(t.encode(), hasher) for _, t in docs]
    strange = np.unique(np.concatenate(bodies))
    idf = np.bincount(np.searchsorted(strange, np.concatenate(bodies)))
    want, texts = {}, []
    for share in (0.2, 0.25):
        for kind in ("even", "rare"):
            for i, item in enumerate(found):
                n = len(item.words)
                k = int(share * n)
                often = idf[np.minimum(np.searchsorted(strange, item.words), len(strange) - 1)]
                at = (np.arange(k) * n / k).astype(int) if kind == "even" else np.argsort(often, kind="stable")[:k]
                words = item.words.copy()
                words[at] = rnd.choices(strange.tolist(), k=k)
                body = rnd.choice(bodies)[:60]
                texts.append(np.concatenate([body[:30], words, body[30:]]))
                want[len(texts) - 1, i] = accepted_places(texts[-1], item)
    lens = np.array([len(t) for t in texts])
    kept, begin = {}, np.cumsum(lens) - lens
    for t, i, lo, hi in search.places(np.concatenate(texts), lens).tolist():
        kept.setdefault((t, i), []).append((lo - begin[t], hi - begin[t]))
    for pair, places in want.items():  # the bound loses no accepted place
        assert all(any(lo <= at <= hi for lo, hi in kept[pair]) for at in places)
    got = search.search(np.concatenate(texts), lens)
    missed = [pair for pair, places in want.items() if places and pair not in got]
    assert sum(map(bool, want.values())) > 60 and not missed


def test_short_items_copied_word_for_word_are_found(spark):
    docs, items, _ = corpus(7)
    cut = [(100 * size + i, " ".join(t.split()[:size])) for size in range(D.MIN_ITEM_WORDS, 17) for i, t in items if len(t.split()) >= size]
    found, search = latent(spark, docs, cut)
    bodies = [D.word_ids(t.encode(), WordHasher(D.PUNCTUATION)) for _, t in docs]
    strange = np.unique(np.concatenate(bodies))
    rnd = random.Random(8)
    texts = [np.concatenate([rnd.choice(bodies)[:20], rnd.choices(strange, k=k % 13), x.words, rnd.choices(strange, k=12)]).astype("<u4") for k, x in enumerate(found)]
    got = search.search(np.concatenate(texts), np.array([len(t) for t in texts]))
    assert len(found) > 150 and [k for k in range(len(found)) if got.get((k, k), (0,))[0] < len(found[k].words)] == []


def test_separate_answer_after_the_question(spark):
    docs, _, _ = corpus(9)
    rnd = random.Random(10)
    question, answer, other = (" ".join(f"{name}{rnd.randrange(10 ** 6)}" for _ in range(n)) for name, n in (("q", 40), ("a", 20), ("o", 25)))
    rows = [*docs, (1000, f"{docs[0][1]} {question} {answer} {docs[1][1]}"), (1001, f"{docs[2][1]} {answer} {question}"), (1002, f"{question} {other} {docs[3][1]}")]
    bench = spark.createDataFrame([(5, question, answer)], "item_id long, text string, answer string")
    got = D.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench, answer_col="answer").collect()
    assert sorted((r.doc_id, r.common_words, r.answer_found) for r in got) == [(1000, 40, 20), (1001, 40, 20)]


def test_one_block_is_held_at_a_time(spark, monkeypatch):
    docs, items, _ = corpus(11)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(i, t, "unrelated words") for i, t in items], "item_id long, text string, answer string")
    want = sorted(map(tuple, D.leaks(df, bench.drop("answer")).collect()))
    from pyspark.core.broadcast import Broadcast
    live, most, make, destroy = set(), [], spark.sparkContext.broadcast, Broadcast.destroy

    def made(value):
        b = make(value)
        live.add(id(b)) if isinstance(value, list) else None
        most.append(len(live))
        return b

    def destroyed(self, *given):
        live.discard(id(self))
        return destroy(self, *given)

    monkeypatch.setattr(spark.sparkContext, "broadcast", made)
    monkeypatch.setattr(Broadcast, "destroy", destroyed)
    size = max(1, len(items) // 20)
    # a column that happens to be named answer says nothing
    assert sorted(map(tuple, D.leaks(df, bench, block_items=size).collect())) == want and want
    assert len(most) > 10 and max(most) == 1 and not live


def test_sketch_has_no_more_partial_sums_than_cores_need(spark, tmp_path, monkeypatch):
    """48 parts of the input, and the sums of a single pass over all rows."""
    rng = np.random.default_rng(2)
    docs = [(i, rng.integers(0, 1 << 32, int(rng.integers(0, 90)), dtype=np.uint32).astype("<u4").tobytes()) for i in range(480)]
    tokens = spark.createDataFrame(docs, "doc_id long, words binary").repartition(48)
    idf = rng.random(D.TERMS, dtype=np.float32) + 1
    parts, plain = [], D.partial_sketches

    def kept(*a):
        parts.append(plain(*a))
        return parts[-1]

    monkeypatch.setattr(D, "partial_sketches", kept)
    z = D.sketch(tokens, idf, 4)
    most = D._Z_WAVES * spark.sparkContext.defaultParallelism
    assert most < 48 and max(r["count"] for r in parts[0].groupBy("block").count().collect()) <= most
    x, want = D.test_matrix(4).astype(float), np.zeros((D.TERMS, 4))
    for _, raw in docs:
        words = np.frombuffer(raw, dtype="<u4") & (D.TERMS - 1)
        for lo in range(0, len(words), D.PASSAGE):
            term, tf = np.unique(words[lo:lo + D.PASSAGE], return_counts=True)
            w = tf * idf[term].astype(float)
            w /= np.linalg.norm(w)
            want[term] += w[:, None] * (x[term] * w[:, None]).sum(axis=0)
    assert np.allclose(z, want, atol=1e-4)
