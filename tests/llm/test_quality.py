"""Rule counts against plain loops; the forest and its threshold on labelled data."""

import random
import re
from collections import Counter

import numpy as np
from llm_data import SF01

from tickforge.llm import quality as Q


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    win = [tuple(words[i:i + 3]) for i in range(n - 2)]
    c = Counter(win)
    inside = {i + k for i, w in enumerate(win) if c[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return n, sum(map(len, words)), sum(ch in "#*$%&|<>" for ch in text), dup, len(inside)


def texts():
    rnd = random.Random(6)
    bits = ["a", "b", "c", "é", "日", "#", "|", "x!", "\u0085", " ", "A"]
    out = ["".join(rnd.choice(bits) + rnd.choice([" ", "\n", "  ", "\t", "\n\n"]) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    return [*out, "", None, " \n \n", "same line\nsame line\n\x0b\n\x0b\nsame line", "a b c a b c", "w " * 200]


def test_counts():
    for t in texts():
        assert Q.measure(t)[:5] == slow(t), repr(t)


def test_many_words_take_the_other_form(monkeypatch):
    ts = [t for t in texts() if t]
    want = [Q.repeat_words(t.encode().split()) for t in ts]
    monkeypatch.setattr(Q, "_MANY", 0)
    assert [Q.repeat_words(t.encode().split()) for t in ts] == want


def test_forest_scores_equal_a_walk_down_each_tree():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 1, (600, 3)), [[9, 9, 9]], [[0, 0, 0]]])
    f = Q.grow(x, trees=20, subsample=64)

    def walk(row):
        total = 0
        for node in f.roots:
            while f.feature[node] >= 0:
                node = f.left[node] if row[f.feature[node]] < f.threshold[node] else f.right[node]
            total += f.length[node]
        return 2 ** (-total / 20 / float(Q._mean_path(64)))

    got = f.scores(x)
    assert np.allclose(got, [walk(r) for r in x])
    assert got[600] > np.quantile(got, 0.99) and got[601] < np.median(got)


def test_labelled_documents(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    rows = {r.doc_id: r for r in Q.judge(docs, labels).collect()}
    assert len(rows) == docs.count()
    for r in docs.collect():
        got = rows[r.doc_id]
        n, chars, symbols, dup, rep = slow(r.text)
        assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert got.base_failed == (n < 50 or 100 * rep > 50 * n) and (not got.kept or not got.base_failed)
    judged = [(r.quality, rows[r.doc_id].kept) for r in labels.collect() if not rows[r.doc_id].base_failed]
    good = [k for q, k in judged if q == 1]
    bad = [k for q, k in judged if q == 0]
    assert sum(good) / len(good) >= 0.99
    assert sum(bad) / len(bad) <= 0.05


def test_repeats_decide_where_labels_say_so(spark):
    rnd = random.Random(3)
    text = lambda: "\n".join(" ".join(rnd.choice("abcdefgh") * rnd.randint(2, 9) + str(rnd.randint(0, 9999)) for _ in range(12)) for _ in range(10))
    rows = [(i, text()) for i in range(400)]
    rows += [(400 + i, t + "\n" + "\n".join([t.split("\n")[0]] * 4)) for i, t in enumerate(text() for _ in range(30))]  # 30 % repeated windows
    labels = spark.createDataFrame([(i, int(i < 400), 0) for i in range(430) if i % 2], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in Q.judge(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()}
    assert not any(r.base_failed for r in got.values())
    assert all(got[i].kept for i in range(400)) and not any(got[i].kept for i in range(400, 430))


def test_edges(spark):
    rows = [(1, "word " * 60, "x"), (1, "word " * 60, "x"), (None, None, None), (2, " ".join(f"w{i}" for i in range(80)), "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = sorted(((r.doc_id, r.n_words, r.base_failed, r.kept) for r in Q.judge(df, none).collect()), key=str)
    assert got == sorted([(1, 60, True, False), (1, 60, True, False), (None, 0, True, False), (2, 80, False, True)], key=str)
    assert Q.judge(df.limit(0), none).count() == 0


def test_repeated_labels_count_once_and_rows_in_any_order_give_one_forest(spark):
    rows = [(i, 0.001 * (i % 400), 0.1, 0.2, 5.0) for i in range(400)]
    df = spark.createDataFrame([(i, a + (0.5 if i < 40 else 0), 0.4) for i, a, *_ in rows], "doc_id long, anomaly_shape double, anomaly_repeats double")
    once = spark.createDataFrame([(i, int(i >= 40)) for i in range(400)], "doc_id long, quality int")
    assert Q.thresholds(df, once) == Q.thresholds(df, once.unionByName(once.filter("doc_id < 5 or doc_id > 390")).unionByName(once))
    stats = Q.measured(spark.createDataFrame([(i % 50, f"word{i % 7} more, words! here {i % 3}") for i in range(3000)], "doc_id long, text string"))
    a, b = (Q.fit(x, trees=4, subsample=32) for x in (stats.repartition(7), stats.repartition(3, "n_words")))
    assert all(np.array_equal(x, vars(b[g])[k]) for g in Q.GROUPS for k, x in vars(a[g]).items())
