"""Line dedup against a plain count of lines, and its SQL twin on odd rows."""

import hashlib
import re

import duckdb

from tickforge.llm import line_dedup as L
from tickforge.llm.queries import ORACLES


def key(line):
    return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(str.maketrans(L.UPPER, L.LOWER))


def slow(rows):
    docs = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= L.MIN_CHARS:
                docs.setdefault(key(line), set()).add((doc is None, doc))
    first = {k: min(d, key=lambda x: (x[0], x[1] or 0)) for k, d in docs.items() if len(d) >= L.MIN_DOCS}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if first.get(key(x), (doc is None, doc)) == (doc is None, doc)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


ROWS = [
    (1, "All rights reserved 2024\nown line of one\n\nshort"), (2, "  ALL RIGHTS reserved 2024\t\nshort\nown line of two\n"), (3, None), (4, ""),
    (5, "\n\n"), (6, "all rights reserved 2024\r\nÉté à la mer\nall rights reserved 2024"), (7, "été à la mer\nÉté à la mer"), (8, "😀😀😀😀😀😀😀😀😀😀\nx"),
    (9, "😀😀😀😀😀😀😀😀😀😀"), (10, "123456789\n1234567890"), (11, "123456789\n1234567890\v"), (12, "twice in this one\ntwice in this one"),
    (13, "only line kept here, once"), (13, "only line kept here, once"), (13, "another text of thirteen\nAll rights reserved 2024"), (0, "a line of the first\n a line of the first "),
    (14, "a line of the first"), (15, "a line of the first\nlast words of it\nA LINE OF THE FIRST\n\n"), (None, "no id, some line\nlast words of it"), (None, "no id, some line"),
    (16, " non-breaking space\nx"), (17, "non-breaking space"), (18, "x" * 200_000 + "\n" + "the same line\n" * 20_000), (19, "the same line\n" + "x" * 200_000),
]


def test_equals_a_plain_count(spark):
    df = spark.createDataFrame([(*r, 1, "a") for r in ROWS], "doc_id long, text string, n_lines long, gone string")
    got = L.kept_lines(df)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, slow(ROWS)))
    assert "Python" not in got._jdf.queryExecution().toString()


def test_all_columns_stay(spark):
    names = ["doc_id", "c0", "text", "id", "t1", "own1", "gone", "pos", "a.b"]
    df = spark.createDataFrame([(d, 1, t, "i", "t", "o", "g", "p", "dot") for d, t in ROWS], "doc_id long, c0 long, text string, id string, t1 string, own1 string, gone string, pos string, `a.b` string")
    got = L.deduplicated(df)
    assert got.columns == names
    want = sorted(str((d, 1, None if t is None else kept, "i", "t", "o", "g", "p", "dot")) for (d, t), (_, _, _, kept) in zip(ROWS, slow(ROWS)))
    assert sorted(str(tuple(r)) for r in got.collect()) == want


def test_threshold_of_three_documents(spark):
    df = spark.createDataFrame([(1, "in three documents"), (2, "in three documents\nin two documents"), (3, "in two documents\nIn three documents")], "doc_id long, text string")
    assert {(r.doc_id, r.kept) for r in L.kept_lines(df, min_docs=3).collect()} == {(1, "in three documents"), (2, "in two documents"), (3, "in two documents")}


def test_sql_twin(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/d/*.parquet'")
    want = sorted(str((d, n, m, hashlib.sha256(k.encode()).hexdigest())) for d, n, m, k in slow(ROWS))
    assert sorted(str(r) for r in con.execute(ORACLES["op11_line_dedup"]).fetchall()) == want


def test_a_hot_line(spark):
    rows = [(i, f"line number {i}\nevery document holds this" if i % 3 else "every document holds this") for i in range(3000)]
    got = L.kept_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 3000 and sum(r.n_dropped for r in got) == 2999
    assert all(r.kept == (f"line number {r.doc_id}" if r.doc_id % 3 else "every document holds this" if r.doc_id == 0 else "") for r in got)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.kept_lines(df).count() == 0 and L.deduplicated(df).count() == 0
