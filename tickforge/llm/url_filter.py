"""URL filters by a broadcast trie over reversed host labels and path segments.

A rule names a host and a path.  It fits its host and all subdomains when the
url's path starts with the rule's path.  Of the rules that fit, the one with
the most host labels wins, then the one with the longest path; an allow and a
block entry of the same host and path count as block.

The trie's first levels are host labels from the right; each host node has a
second trie over path segments, whose nodes hold the last, possibly unfinished
segment of the rules that end there.  A trie is broadcast only up to
``MAX_TRIE_RULES`` rules and about ``MAX_TRIE_BYTES`` of memory.  Larger rule
tables are dealt by hash into blocks of that size: one block at a time is
broadcast, and every url keeps the longest rule of the blocks so far.

Defined results: a null url or one without ``://`` has empty host and path and
no rule; without a rule the verdict is the default; repeated and null page ids
are kept; an empty table gives an empty result; an empty rule list gives the
default everywhere; rules with a null part are left out; other columns are
ignored.  Urls and rules may be of any length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import run_folder, written

ALLOW, BLOCK = "allow", "block"
MAX_TRIE_RULES = 200_000
MAX_TRIE_BYTES = 256 << 20
NODE_BYTES = 300  # of a dict with one entry, with its key's object
RULE_SCHEMA = "host string, path string, verdict string"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://``; A-Z of the host lower-cased."""
    known = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(known, URL_PATTERN, 1), UPPER, LOWER)
    return host, F.regexp_extract(known, URL_PATTERN, 2)


class Trie:
    """Host labels from the right, then path segments."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        self.hosts: dict = {}
        for rule in rules:
            labels = rule.host.translate(str.maketrans(UPPER, LOWER)).split(".")
            node = self.hosts
            for label in reversed(labels):
                node = node.setdefault(label, {})
            paths = node.setdefault(None, {})  # no label is None
            *whole, tail = rule.path.split("/")
            for segment in whole:
                paths = paths.setdefault(segment, {})
            tails = paths.setdefault(None, {})
            if len(tail) not in (sizes := paths.setdefault(0, [])):  # no segment is 0
                sizes.append(len(tail))
                sizes.sort(reverse=True)
            if tails.get(tail) != BLOCK:
                tails[tail] = rule.verdict

    def __reduce__(self) -> tuple:
        """A trie is sent as its rules and built again: pickle cannot follow a path of thousands of segments."""
        return Trie, (self.rules,)

    @staticmethod
    def _path(paths: dict, segments: list[str]) -> tuple[str, str] | None:
        best, done = None, []
        for segment in segments:
            tail = next((segment[:n] for n in paths.get(0, ()) if segment[:n] in paths[None]), None)
            if tail is not None:
                best = (len(done), tail, paths[None][tail])
            paths = paths.get(segment)
            if paths is None:
                break
            done.append(segment)
        return best and ("/".join([*done[:best[0]], best[1]]), best[2])

    def match(self, host: str, path: str) -> tuple[int, int, str | None, str | None]:
        """(host labels, path characters, rule text, verdict) of the longest rule that fits, or ``NO_RULE``."""
        labels, node, best = host.split("."), self.hosts, None
        segments = path.split("/")
        for depth in range(len(labels) - 1, -1, -1):
            node = node.get(labels[depth])
            if node is None:
                break
            paths = node.get(None)
            found = self._path(paths, segments) if paths else None
            if found:
                best = (depth, *found)
        if best is None:
            return NO_RULE
        depth, fit, verdict = best
        return len(labels) - depth, len(fit), ".".join(labels[depth:]) + fit, verdict


NO_RULE = (-1, -1, None, None)
FIT = (("labels", pa.int32()), ("chars", pa.int32()), ("rule", pa.string()), ("verdict", pa.string()))


def _by_trie(urls: DataFrame, trie: Broadcast) -> DataFrame:
    """page_id, host, path and the longest rule of ``urls``, which may have one of earlier blocks, and of the trie."""
    names = [n for n, _ in FIT]
    earlier = "rule" in urls.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = trie.value.match
        for b in batches:
            found = [match(h, p) for h, p in zip(b.column("host").to_pylist(), b.column("path").to_pylist())]
            if earlier:  # a rule is in one block, so two rules that fit are never of one length
                found = list(map(max, found, zip(*(b.column(n).to_pylist() for n in names))))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *(pa.array([f[i] for f in found], t) for i, (_, t) in enumerate(FIT))],
                                             names=["page_id", "host", "path", *names])

    return urls.mapInArrow(work, f"page_id {urls.schema['page_id'].dataType.simpleString()}, host string, path string, labels int, chars int, rule string, verdict string")


def judge(pages: DataFrame, rules: DataFrame | list[Rule], url_col: str = "url", id_col: str = "page_id",
          default: str = ALLOW, max_trie_rules: int = MAX_TRIE_RULES, max_trie_bytes: int = MAX_TRIE_BYTES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row."""
    spark: SparkSession = pages.sparkSession
    host, path = split_url(F.col(url_col))
    split = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    table = rules if isinstance(rules, DataFrame) else spark.createDataFrame(rules, RULE_SCHEMA)
    once = (table.filter("host is not null and path is not null and verdict is not null")
            .groupBy(F.translate("host", UPPER, LOWER).alias("host"), "path")
            .agg(F.when(F.max((F.col("verdict") == BLOCK).cast("int")) == 1, BLOCK).otherwise(ALLOW).alias("verdict")))
    nodes = F.size(F.split("host", r"\.")) + F.size(F.split("path", "/")) + 2
    n, cost = once.agg(F.count("*"), F.sum(nodes.cast("long") * NODE_BYTES + F.octet_length("host") + F.octet_length("path"))).first()
    blocks = max(1, math.ceil(n / max_trie_rules), math.ceil((cost or 0) / max_trie_bytes))

    def search(urls: DataFrame, part: DataFrame) -> tuple[DataFrame, Broadcast]:
        trie = spark.sparkContext.broadcast(Trie([Rule(r["host"], r["path"], r["verdict"]) for r in part.collect()]))
        return _by_trie(urls, trie), trie

    if blocks == 1:
        found, _ = search(split, once)
    else:
        folder, found = run_folder(spark, "url_filter"), split
        once.withColumn("block", F.pmod(F.xxhash64("host", "path"), F.lit(blocks))).write.partitionBy("block").parquet(f"{folder}/rules")
        dealt = spark.read.schema(f"{RULE_SCHEMA}, block long").parquet(f"{folder}/rules")
        for k in range(blocks):  # the results are written, so that one trie is held at a time
            better, trie = search(found, dealt.filter(F.col("block") == k))
            found = written(better, f"{folder}/found{k}")
            trie.destroy()
    return found.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
