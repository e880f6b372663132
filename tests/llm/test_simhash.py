"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import xxhash

from tickforge.llm import simhash as S


def slow_fingerprint(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(fps, ids, budget=3):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= budget:
                root[find(i)] = find(j)
    out = {}
    for i in range(len(fps)):
        if ids[i] is not None:
            out[find(i)] = min(out.get(find(i), ids[i]), ids[i])
    return [out.get(find(i)) for i in range(len(fps))]


def texts(seed=5, n=120):
    rnd = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)] + ["Été", "naïve", "A"]
    base = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 90))) for _ in range(n // 3)]
    out = list(base)
    for t in base:
        w = t.split(" ")
        for _ in range(2):
            v = list(w)
            for _ in range(rnd.randint(0, 2)):
                v[rnd.randrange(len(v))] = rnd.choice(vocab)
            out.append(rnd.choice([" ", "\n", "\t "]).join(v).upper() if rnd.random() < .3 else " ".join(v))
    return out + ["", None, "  \n", "one", "one two", "one two", "x" * 50_000]


def test_fingerprint_is_the_majority_vote():
    for t in texts():
        assert S.fingerprint(t.encode() if t is not None else None) == slow_fingerprint(t)
    long = " ".join(str(i % 977) for i in range(70_000))
    assert S.fingerprint(long.encode()) == slow_fingerprint(long)


def test_trie_links_equal_brute_force():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 1 << 63, 60, dtype=np.uint64)
    noisy = [b ^ np.uint64(1 << int(i)) ^ np.uint64(1 << int(j)) for b in base for i, j in rnd.integers(0, 63, (6, 2))]
    fps = np.unique(np.concatenate([base, np.array(noisy, dtype=np.uint64), np.arange(40, dtype=np.uint64)]))
    for wave in (7, 1 << 15):
        labels = S.trie_links(fps, np.array([0]), np.array([len(fps)]), 3, wave=wave)
        want = slow_components([int(x) for x in fps], list(range(len(fps))))
        assert labels.tolist() == want


def test_components_equal_brute_force(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts())]
    rows += [(7, rows[7][1], "en", "s", 0), (None, rows[3][1], "en", "s", 0), (None, "only nulls hold this text here", "en", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, root string, u long")
    got = S.near_duplicates(df).collect()
    fps = [slow_fingerprint(r[1]) for r in rows]
    want = sorted(zip([r[0] for r in rows], fps, slow_components(fps, [r[0] for r in rows])), key=str)
    assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=str) == want
    kept = S.keep_one_per_group(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted({w[2] for w in want}, key=str)


def test_hot_cells_are_cut_without_losing_links(spark):
    rnd = random.Random(3)
    fps = [0x1234_5678_9ABC_DEF0 ^ (1 << rnd.randrange(63)) ^ (1 << rnd.randrange(63)) for _ in range(300)]
    fps = sorted({f for f in fps})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for rows in (16, 4096):
        edges = S.links(df, 3, cell_rows=rows).collect()
        root = {f: f for f in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for e in edges:
            root[find(e.u)] = find(e.v)
        want = slow_components(fps, fps)
        groups = {}
        for f, w in zip(fps, want):
            groups.setdefault(w, set()).add(find(f))
        assert all(len(g) == 1 for g in groups.values()) and len({find(f) for f in fps}) == len(groups)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).count() == 0
    assert S.keep_one_per_group(df).count() == 0
