"""WARC archives of pages with a two-level capture index.

Writing.  A narrow pass finds, per payload digest, the page that stays a
response (the least page id); all others become revisit records.  Pages are
then range-partitioned and sorted by (reversed-host url key, page id), and
each task writes one shard: a WARC file of gzip members, an index of the keys
in compressed blocks of ``BLOCK_LINES`` lines, and a sparse directory with the
first key and place of every block.  Shard files carry a fresh name per
attempt; only those that a committed manifest row names are ever read.

Reading.  Lookup keys are range-partitioned the same way.  A task finds the
shard, binary-searches its directory, range-reads one block, binary-searches
the block and range-reads the record.  Per task it holds one directory and
one block at a time.

Archives live below a folder that driver and executors share, opened with
``pyarrow.fs`` (local or mounted paths, hdfs, s3, gs).

Defined results: null html is the empty payload; a null url is archived as
``about:blank``; payloads below ``min_bytes`` are always responses; rows that
share the least page id of a payload are all responses; a null id sorts before
all ids in the index and counts as larger than all as a response; repeated
rows give repeated records; no pages give no shards and no captures; further
columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import run_folder, written
from tickforge.llm.url_filter import split_url

BLOCK_LINES = 512
LEVEL = 4
DATE = "2000-01-01T00:00:00Z"
BLANK = "about:blank"
# Fixed value: the profile of revisits by payload digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard string, first_key string, first_id long, records long"
CAPTURE = "page_id long, url_key string, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def url_key(url: Column) -> Column:
    """Reversed host labels, then the rest of the url: ``net,example)/en/1?x``."""
    known = F.coalesce(url, F.lit(BLANK))
    host, _ = split_url(known)
    rest = F.regexp_replace(known, r"(?s)^.*?://[^/?#]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(folder: str):
    """Arrow file system and path of a folder uri."""
    from pyarrow import fs
    uri = "file://" + folder[5:] if folder.startswith("file:/") and not folder.startswith("file://") else folder
    return fs.FileSystem.from_uri(uri)


def _header_text(s: str) -> str:
    """A header value on one line: control characters percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in s)


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    """The same for wholly equal captures only."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {digest} {url}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers: tuple[int, str | None] | None) -> bytes:
    """One WARC 1.1 record: a response with its payload, or a revisit of ``refers`` (page id, url)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: {record_id(page_id, url, digest)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {_header_text(url or BLANK)}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if refers:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(*refers, digest)}",
                 f"WARC-Refers-To-Target-URI: {_header_text(refers[1] or BLANK)}", f"WARC-Refers-To-Page-ID: {refers[0]}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, HTTP body) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]) or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("truncated WARC record")
    return fields, block.partition(b"\r\n\r\n")[2]


def _order(key: str, page_id: int | None) -> tuple[bytes, int, int]:
    """Sort key as Spark orders (string, long): bytes, nulls first."""
    return key.encode(), page_id is not None, page_id or 0


class _ShardWriter:
    def __init__(self, folder: str):
        self.fs, self.base = _open(folder)
        self.shard = uuid.uuid4().hex
        self.fs.create_dir(self.base, recursive=True)
        self.warc = self.fs.open_output_stream(f"{self.base}/{self.shard}.warc.gz", compression=None)
        self.index = self.fs.open_output_stream(f"{self.base}/{self.shard}.idx", compression=None)
        self.at = self.index_at = self.records = 0
        self.lines: list[str] = []
        self.directory: list[list] = []
        self.first: tuple | None = None

    def add(self, key: str, page_id: int | None, data: bytes) -> None:
        z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        member = z.compress(data) + z.flush()
        self.warc.write(member)
        if not self.lines:
            self.directory.append([key, page_id, self.index_at])
        if self.first is None:
            self.first = (key, page_id)
        self.lines.append(json.dumps([key, page_id, self.at, len(member)]))
        self.at += len(member)
        self.records += 1
        if len(self.lines) == BLOCK_LINES:
            self._block()

    def _block(self) -> None:
        data = zlib.compress("\n".join(self.lines).encode())
        self.index.write(data)
        self.directory[-1].append(len(data))
        self.index_at += len(data)
        self.lines = []

    def close(self) -> pa.RecordBatch:
        if self.lines:
            self._block()
        self.warc.close()
        self.index.close()
        with self.fs.open_output_stream(f"{self.base}/{self.shard}.dir", compression=None) as out:
            out.write(zlib.compress("\n".join(map(json.dumps, self.directory)).encode()))
        return pa.RecordBatch.from_arrays([pa.array([self.shard]), pa.array([self.first[0]]), pa.array([self.first[1]], pa.int64()), pa.array([self.records], pa.int64())],
                                          names=["shard", "first_key", "first_id", "records"])


def _revisits(pages: DataFrame, folder: str, min_bytes: int) -> DataFrame:
    """(url_key, page_id, digest, refers_to, refers_url) of the pages that revisit another."""
    narrow = (pages.select("page_id", "url", "url_key", F.sha1(F.coalesce("html", F.lit(""))).alias("digest"), F.octet_length(F.coalesce("html", F.lit(""))).alias("bytes"))
              .filter(F.col("bytes") >= min_bytes))
    first = (narrow.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")).alias("f"))
             .filter("n > 1").select(F.col("digest").alias("f_digest"), F.col("f.page_id").alias("refers_to"), F.col("f.url").alias("refers_url")))
    found = (narrow.join(first, F.col("digest") == F.col("f_digest")).filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
             .select("url_key", "page_id", "digest", "refers_to", "refers_url").distinct())
    return written(found, folder)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per row below ``folder``; the manifest (one row per shard)."""
    plain = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    plain = plain.withColumn("url_key", url_key(F.col("url")))
    said = _revisits(plain, f"{folder}/revisits", min_bytes)
    none = F.lit(None)
    rows = (plain.select("url_key", "page_id", F.lit(1).alias("kind"), "url", "html", none.cast("string").alias("digest"), none.cast("long").alias("refers_to"))
            .unionByName(said.select("url_key", "page_id", F.lit(0).alias("kind"), F.col("refers_url").alias("url"), none.cast("string").alias("html"), "digest", "refers_to")))
    dealt = rows.repartitionByRange("url_key", "page_id").sortWithinPartitions("url_key", "page_id", "kind")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, refers = None, None, {}
        for b in batches:
            cols = [b.column(n) for n in ("url_key", "page_id", "kind", "url", "digest", "refers_to")]
            html = b.column("html").cast(pa.binary())
            for i, (k, page_id, kind, url, digest, to) in enumerate(zip(*(c.to_pylist() for c in cols))):
                if (k, page_id) != key:
                    key, refers = (k, page_id), {}
                if kind == 0:
                    refers[digest] = (to, url)
                    continue
                payload = html[i].as_py() or b""
                sha = hashlib.sha1(payload)
                out = out or _ShardWriter(f"{folder}/archives")
                out.add(k, page_id, record(page_id, url, payload, base64.b32encode(sha.digest()).decode(), refers.get(sha.hexdigest())))
        if out:
            yield out.close()

    return written(dealt.mapInArrow(work, MANIFEST), f"{folder}/manifest")


class CaptureIndex:
    """Reads captures of the shards that a manifest names."""

    def __init__(self, folder: str, manifest: list[tuple[str, str, int | None]]):
        self.fs, self.base = _open(f"{folder}/archives")
        self.shards = sorted((_order(key, page_id), shard) for shard, key, page_id in manifest)
        self.starts = [s[0] for s in self.shards]
        self.shard = None

    def _load(self, shard: str) -> None:
        if self.shard != shard:
            with self.fs.open_input_file(f"{self.base}/{shard}.dir") as f:
                self.directory = [json.loads(x) for x in zlib.decompress(f.read()).decode().split("\n")]
            self.firsts = [_order(d[0], d[1]) for d in self.directory]
            self.index = self.fs.open_input_file(f"{self.base}/{shard}.idx")
            self.warc = self.fs.open_input_file(f"{self.base}/{shard}.warc.gz")
            self.shard, self.block_at = shard, -1

    def _load_block(self, k: int) -> None:
        if self.block_at != k:
            _, _, at, size = self.directory[k]
            self.lines = [json.loads(x) for x in zlib.decompress(self.index.read_at(size, at)).decode().split("\n")]
            self.keys = [_order(x[0], x[1]) for x in self.lines]
            self.block_at = k

    def records(self, key: str, page_id: int | None) -> Iterator[bytes]:
        """All records of one (key, page id), by binary search and range reads."""
        want = _order(key, page_id)
        at = bisect.bisect_right(self.starts, want) - 1
        if at < 0:
            return
        self._load(self.shards[at][1])
        k = max(bisect.bisect_left(self.firsts, want) - 1, 0)  # equal keys may begin in the block before
        while k < len(self.directory) and self.firsts[k] <= want:
            self._load_block(k)
            i = bisect.bisect_left(self.keys, want)
            while i < len(self.keys) and self.keys[i] == want:
                _, _, offset, size = self.lines[i]
                yield zlib.decompress(self.warc.read_at(size, offset), 31)
                i += 1
            k += 1


def read_captures(keys: DataFrame, manifest: DataFrame, folder: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """The captures of the given (url_key, page_id): all records with each key once.
    ``columns`` picks fields of a capture (all by default)."""
    fields = [f.strip().split(" ") for f in CAPTURE.split(",")]
    pick = [f for f in fields if not columns or f[0] in columns]
    shards = [(r["shard"], r["first_key"], r["first_id"]) for r in manifest.collect()]  # one row per write task
    wanted = keys.select("url_key", "page_id")
    # as many tasks as wrote: those were dealt by payload bytes, of which a key shows nothing
    dealt = wanted.repartitionByRange(max(1, len(shards)), "url_key", "page_id").sortWithinPartitions("url_key", "page_id")
    shared = keys.sparkSession.sparkContext.broadcast(shards)
    if not shards:
        return dealt.limit(0).mapInArrow(lambda it: it, ", ".join(map(" ".join, pick)))

    def capture(key: str, data: bytes) -> tuple:
        head, body = parse_record(data)
        revisit = head["WARC-Type"] == "revisit"
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else base32_digest(body)
        if not revisit and head["WARC-Payload-Digest"] != f"sha1:{digest}":
            raise ValueError(f"payload of {head['WARC-Record-ID']} does not have its digest")
        page_id = head.get("WARC-Page-ID")
        return (None if page_id is None else int(page_id), key, head["WARC-Target-URI"], None if revisit else body,
                int(head["WARC-Payload-Length"]) if revisit else len(body), digest, head["WARC-Type"], int(head["WARC-Refers-To-Page-ID"]) if revisit else None)

    places = [[f[0] for f in fields].index(p[0]) for p in pick]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, last = None, None
        for b in batches:
            index = index or CaptureIndex(folder, shared.value)
            rows = []
            for key in zip(b.column("url_key").to_pylist(), b.column("page_id").to_pylist()):
                if key != last:
                    for data in index.records(*key):
                        got = capture(key[0], data)
                        rows.append([got[p] for p in places])
                        if len(rows) == 256:
                            yield pa.RecordBatch.from_arrays([pa.array(c, types[p[1]]) for c, p in zip(zip(*rows), pick)], names=[p[0] for p in pick])
                            rows = []
                last = key
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, types[p[1]]) for c, p in zip(zip(*rows), pick)], names=[p[0] for p in pick])

    return dealt.mapInArrow(work, ", ".join(map(" ".join, pick)))


def page_keys(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    return pages.select(url_key(F.col(url_col).cast("string")).alias("url_key"), F.col(id_col).cast("long").alias("page_id"))


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archive all pages, read every capture back through the index."""
    folder = run_folder(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder, min_bytes)
    return read_captures(page_keys(pages), manifest, folder, ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex, min(page_id) OVER (PARTITION BY body) AS first_id FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST(((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM d
"""
