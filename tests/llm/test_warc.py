"""Archives, index and read-back against the rows that went in."""

import gzip
import io

from tickforge.llm import warc as W
from tickforge.llm.common import run_folder


def sample():
    rows = [(i, f"http://{'abc'[i % 3]}.example.org/p{i % 40}?q={i}", f"<p>{i % 70}é</p>" * (1 + i % 5)) for i in range(1500)]
    rows += [(2000 + i, "http://same.net/x", "same body") for i in range(1300)]
    rows += [(5000, None, None), (5001, "", ""), (5002, "no scheme\nx\ty", "a\r\n\r\nWARC/1.1\r\n"), (5003, "http://ü.net/ \r\n", "x" * 400_000)]
    rows += [rows[0], rows[0], (7, rows[7][1], "another body of page 7"), (None, "http://n.net/", "null id"), (None, "http://n.net/", "same body")]
    return rows


def want_of(rows, least=0):
    first = {}
    for pid, _, html in rows:
        b = (html or "").encode()
        if pid is not None:
            first[b] = min(first.get(b, pid), pid)
    out = []
    for pid, _, html in rows:
        b = (html or "").encode()
        to = first.get(b)
        revisit = len(b) >= least and to is not None and to != pid
        out.append((pid, len(b), W.base32_digest(b), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    rows = sample()
    df = spark.createDataFrame([(*r, "k", 0) for r in rows], "page_id long, url string, html string, url_key string, kind int")
    got = W.archive_round_trip(df)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want_of(rows)
    assert sorted((tuple(r) for r in W.archive_round_trip(df, min_bytes=12).collect()), key=str) == want_of(rows, 12)


def test_files_are_plain_gzip_members_and_payloads_come_back(spark):
    rows = sample()
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = run_folder(spark, "warc-test")
    manifest = W.write_archives(df, folder)
    fs, base = W._open(f"{folder}/archives")
    n = 0
    for m in manifest.collect():
        with fs.open_input_file(f"{base}/{m.shard}.warc.gz") as f:
            n += gzip.GzipFile(fileobj=io.BytesIO(f.read())).read().count(b"WARC-Record-ID: ")
    assert n == len(rows) == sum(m.records for m in manifest.collect())
    got = W.read_captures(W.page_keys(df).filter("page_id = 5002 or page_id = 5003"), manifest, folder).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in got} == {r[0]: r[2] for r in rows if r[0] in (5002, 5003)}
    missing = spark.createDataFrame([("zz,none)/", 1), ("", 2), ("net,same)/x", 1)], "url_key string, page_id long")
    assert W.read_captures(missing, manifest, folder).count() == 0


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.archive_round_trip(df).count() == 0


def test_record_ids_differ_by_url():
    one, two = (W.parse_record(W.record(7, u, b"same", W.base32_digest(b"same"), None))[0] for u in ("http://a/", "http://b/"))
    again = W.parse_record(W.record(8, "http://c/", b"same", W.base32_digest(b"same"), (7, "http://b/")))[0]
    assert one["WARC-Record-ID"] != two["WARC-Record-ID"] == again["WARC-Refers-To"]
