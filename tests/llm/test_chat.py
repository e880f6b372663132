"""Snapshot collapse and rendering against a plain comparison of all conversations."""

import hashlib
import random

import duckdb

from tickforge.llm import chat as C


def slow(rows):
    convs = {}
    for cid, turn, role, text in rows:
        convs.setdefault(cid, set()).add((-1 if turn is None else turn, role or "unknown", text or ""))
    order = {c: sorted(s, key=lambda x: (x[0], hashlib.md5(f"{x[0]}:{x[1]}\n{x[2]}".encode()).hexdigest())) for c, s in convs.items()}
    kept = {}
    for c, said in order.items():
        if any(len(o) > len(said) and o[:len(said)] == said for o in order.values()):
            continue
        same = [k for k, o in order.items() if o == said]
        first = min((k is None, k) for k in same)[1] if None not in same or len(same) > 1 else None
        first = min((k for k in same if k is not None), default=None)
        kept[first] = (len(said), len(same))
    out = set()
    for c, (n, copies) in kept.items():
        for b in range(-(-n // C.PART_TURNS)):
            some = order[c][b * C.PART_TURNS:(b + 1) * C.PART_TURNS]
            out.add((c, b, n, copies, "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for _, r, x in some)))
    return out


def sample():
    rnd = random.Random(4)
    rows = []
    for c in range(60):
        n = rnd.randint(1, 6)
        key = rnd.randint(0, 9)
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"said {key if t < 3 else rnd.randint(0, 1)} {t}") for t in range(n)]
    rows += rows[:5]
    rows += [(None, 0, "user", "said 3 0"), (None, 1, None, None), (100, None, "user", "x"), (101, None, "user", "x"), (101, 0, "user", "y"),
             (102, 0, "user", ""), (103, 0, "user", None), (104, 0, "user", "z" * 100_000)]
    rows += [(105, t, "user", f"long {t}") for t in range(2600)] + [(106, t, "user", f"long {t}") for t in range(2100)] + [(107, t, "user", f"long {t}") for t in range(1024)]
    return rows


def test_equals_a_plain_comparison(spark):
    rows = sample()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, n long, block long")
    got = C.formatted(df)
    assert {tuple(r) for r in got.collect()} == slow(rows)
    assert "Python" not in got._jdf.queryExecution().toString()


def test_empty(spark):
    assert C.formatted(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_many_texts_of_one_turn_number_are_spread_over_cells(spark):
    rows = [(None, None, "user", f"text {k}") for k in range(6000)] + [(1, k % 3, "user", f"text {k}") for k in range(4000)]
    rows += [(2, k % 3, "user", f"text {k}") for k in range(4000) if k % 3 < 2] + [(3, 0, "user", "text 0")] + rows[:50]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    t = C.turns(df).cache()
    hashes = {}
    for r in t.collect():
        hashes.setdefault(r.conv_id, set()).add((r.turn, r.h1 % 2**64, r.h2 % 2**64, r.h1, r.h2))
    want = set()
    for c, of in hashes.items():
        p1 = p2 = 0
        for n, (*_, h1, h2) in enumerate(sorted(of), 1):
            p1, p2 = p1 ^ h1, p2 ^ h2
            want.add((c, n, h1, h2, p1, p2, n == len(of)))
    got = C.prefixes(t).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    # what one window of the running XOR has to hold
    assert t.distinct().groupBy("conv_id", "block", "cell").count().agg({"count": "max"}).first()[0] < 40
    got = {tuple(r) for r in C.formatted(df).collect()}
    assert got == slow(rows)
    # null turns and null ids come in bounded parts
    assert max(g[4].count("<|im_end|>") for g in got) == C.PART_TURNS


def test_ties_equal_the_sql_twin(spark):
    rnd = random.Random(9)
    rows = [(c if c < 38 else None, rnd.choice([None, 0, 0, 1, 2]), rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", "é\nc", "", None]))
            for c in range(40) for _ in range(rnd.randint(1, 7))]
    rows += [(50, 3, "user", f"text {k}") for k in range(2500)] + [(51, 3, "user", f"text {k}") for k in range(2500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    conversations = df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"})
    con = duckdb.connect()
    con.register("conversations", conversations)
    want = sorted((tuple(r) for r in con.execute(C.ORACLE).fetchall()), key=str)
    assert sorted((tuple(r) for r in C.formatted(df).collect()), key=str) == want
