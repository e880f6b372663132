"""The classifier chain: held-out quality, out-of-fold inputs, edge cases."""

import numpy as np
from llm_data import SF1
from pyspark.sql import functions as F

from tickforge.llm import toxicity as X
from tickforge.llm.common import WordHasher


def test_features_are_words_and_beginnings_once_per_text():
    words = WordHasher(X.PUNCTUATION)
    idx, ends = X.text_features([b"Abc abc abd", b"", None, b"abcdef"], words)
    assert ends.tolist()[1:3] == [ends[0], ends[0]]
    one = idx[:ends[0]]
    assert len(set(one.tolist())) == len(one) == 4  # two words, two beginnings
    again, _ = X.text_features([b"abd, (abc)"], words)
    assert again.tolist() == one.tolist()


def test_logistic_fit_separates():
    rng = np.random.default_rng(0)
    rows = [np.unique(np.append(rng.integers(100, 400, 30), 7 if k % 4 == 0 else 8)) for k in range(400)]
    y = np.array([float(k % 4 == 0) for k in range(400)])
    idx, ends = np.concatenate(rows), np.cumsum([len(r) for r in rows])
    m = X.fit_logistic(idx, ends, np.zeros((400, 0)), y)
    assert ((m.probability(idx, ends, np.zeros((400, 0))) >= 0.5) == (y > 0)).mean() > 0.99
    flat = X.fit_logistic(idx, ends, np.zeros((400, 0)), np.zeros(400))
    assert flat.probability(idx, ends, np.zeros((400, 0))).max() < 0.01


def test_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{SF1}/documents.parquet"), spark.read.parquet(f"{SF1}/labels.parquet")
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    got = {r.doc_id: r for r in X.judge(docs, labels.filter(~out)).collect()}
    assert len(got) == docs.count()
    held = labels.filter(out & (F.col("quality") == 1)).collect()  # junk documents are labelled toxic without toxic words
    hit = [got[r.doc_id].toxic for r in held if r.toxic]
    wrong = [got[r.doc_id].toxic for r in held if not r.toxic]
    assert sum(hit) / len(hit) >= 0.8 and sum(wrong) / len(wrong) <= 0.03
    assert all(0 <= r[f"p_{c.name}"] <= 1 for r in got.values() for c in X.CATEGORIES)


def test_edges(spark):
    rows = [(i, f"some words {'idiot moron' if i % 3 == 0 else 'here'} number {i}", "x", 1) for i in range(60)]
    rows += [(0, rows[0][1], "x", 1), (None, "idiot moron", None, None), (70, None, None, None), (71, "", "", 0), (72, "w " * 300_000, "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic string, p_toxic int")
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)] + [(1, 0, 0), (None, 1, 1), (5, 1, None), (999, 1, 1)], "doc_id long, quality int, toxic int")
    got = X.judge(df, labels).collect()
    assert len(got) == len(rows)
    assert all(r.toxic == (r.doc_id % 3 == 0) for r in got if r.doc_id is not None and r.doc_id < 60)
    assert [r.toxic for r in got if r.doc_id is None] == [True]
    assert not any(r.toxic for r in X.judge(df, labels.limit(0)).collect())
    assert X.judge(df.limit(0), labels).count() == 0


def test_logistic_fit_equals_a_dense_plain_form():
    rng = np.random.default_rng(4)
    rows = [np.unique(rng.integers(0, 40, 6)) for _ in range(80)]
    y = np.array([float(3 in r or 5 in r) for r in rows])
    earlier = rng.uniform(0.1, 0.9, (80, 2))
    m = X.fit_logistic(np.concatenate(rows), np.cumsum([len(r) for r in rows]), earlier, y, steps=25)
    x = np.zeros((80, 40))
    for i, r in enumerate(rows):
        x[i, r] = 1
    x[:, x.sum(axis=0) < X.LEAST_DF] = 0
    dense = np.column_stack((np.log(earlier / (1 - earlier)), np.ones(80)))
    w, v = np.zeros(40), np.array([0, 0, np.log(y.mean() / (1 - y.mean()))])
    sw, sv = np.full(40, 1e-8), np.full(3, 1e-8)
    for _ in range(25):
        r = (1 / (1 + np.exp(-(x @ w + dense @ v))) - y) / 80
        g, gv = x.T @ r, dense.T @ r
        sw, sv = sw + g * g, sv + gv * gv
        step = X.RATE / np.sqrt(sw)
        w = w - step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * X.L1, 0)
        v = v - 0.1 * gv / np.sqrt(sv)
    assert np.allclose(m.features[:40], w, atol=1e-5) and np.allclose([*m.chain, m.intercept], v)


def test_chain_learns_from_out_of_fold_probabilities(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(120):
        idx = np.unique(rng.integers(0, 30, 5))
        y = [int(1 in idx), int(2 in idx), 0, int(1 in idx or 2 in idx or 9 in idx)]
        rows.append((int(i % 3), bytearray(idx.astype("<i4").tobytes()), y))
    got = X.fit_chain(spark.createDataFrame(rows, "fold int, idx binary, y array<int>"))
    order = sorted((f, bytes(i), y) for f, i, y in rows)
    one = [np.frombuffer(i, dtype="<i4").astype(np.int64) for _, i, _ in order]
    fold, y = np.array([f for f, _, _ in order]), np.array([v for _, _, v in order], dtype=float)
    models, p = [], np.zeros((120, 0))  # p: each row's earlier categories, by the models that have not seen its fold
    for c in range(4):
        made = []
        for m in range(X.FOLDS + 1):
            use = np.flatnonzero(fold != m)
            made.append(X.fit_logistic(np.concatenate([one[i] for i in use]), np.cumsum([len(one[i]) for i in use]), p[use], y[use, c]))
        new = np.array([made[f].probability(x, np.array([len(x)]), q[None, :])[0] for f, x, q in zip(fold, one, p)])
        p = np.column_stack((p, new))
        models.append(made[X.FOLDS])
    for a, b in zip(got, models):
        assert np.allclose(a.features, b.features, atol=1e-5) and np.allclose(a.chain, b.chain, atol=1e-6) and np.isclose(a.intercept, b.intercept)


def test_training_rows_stay_bounded(spark, tmp_path):
    rows = [(7, f"text {i} of the shared id") for i in range(20_000)] + [(8, "the same text")] * 10_000 + [(100 + i, f"row {i}") for i in range(10_000)]
    rows += [(50, " ".join(f"word{i}" for i in range(30_000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = df.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")).distinct()
    got = X.training_sample(df, labels, str(tmp_path / "s"), train_rows=2000)
    assert 1000 < got.count() < 2400
    whole = X.training_sample(df, labels, str(tmp_path / "t"), train_rows=10**6)
    sizes = sorted(len(r.idx) // 4 for r in whole.select("idx").collect())
    assert len(sizes) == 30_002 and sizes[-1] == X.ROW_FEATURES
