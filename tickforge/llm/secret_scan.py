"""Secret scans over an incremental blob ledger (DataFrame functions only).

Every version of a file is content-addressed: its blob id is the SHA-256 of
its text.  The ledger holds, per blob, the rule versions that have scanned it
and what they hit.  A scan takes the distinct blobs of the given versions,
drops the (blob, rule version) pairs that the ledger knows, runs the rest and
appends them as one batch; findings are then joined back to all paths and
versions that carry the blob.

Offsets come from splitting a text at a rule's matches: a match starts where
the pieces and matches before it end.  The pieces' lengths become rows and a
running sum, so the work is linear in the number of matches.  ``redacted`` cuts
the text's bytes at the same sums taken over bytes, which is linear too.

Java matches a repeated group by recursion, a frame or more per repetition, so
a rule must have none: a text could otherwise overflow an executor's stack.
Alternatives and single characters or classes may repeat.

Defined results: null text is the empty blob; a row without findings has zero
counts and the digest of the empty string; repeated rows each get their row;
null ids are kept; an empty table gives an empty result; ``redacted`` keeps
all columns of its input, a null text stays null.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickforge.llm.common import numbered, run_folder


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a match counts if its ``group`` has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    def __post_init__(self):
        if re.search(r"(?<!\\)\)(?:[*+]|\{)", self.pattern):
            raise ValueError(f"rule {self.kind} repeats a group")

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base kinds, in the order in which spans of one start are listed.
BASE_RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    # a run is maximal, so a least length in the pattern drops the same matches as a later filter
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
# Further kinds that the scan adds.
MORE_RULES = (
    Rule("hosting", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    # words and single spaces between; the SQL twin says it by a repeated group
    Rule("private_key", 1, r"-----BEGIN (?! )(?![A-Z ]*  )[A-Z ]*(?<= )PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

_HITS = "array<struct<rule:string,n:int,gap:int,len:int,gap_bytes:int,len_bytes:int,good:boolean>>"
LEDGER_SCHEMA = f"blob string, rules array<string>, hits {_HITS}"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _hits(text: Column, rule: Rule) -> Column:
    """All matches of one rule: ordinal, characters and bytes since the last match and of it, and if it counts."""
    p = F.lit(rule.pattern)
    found = [F.split(text, rule.pattern, -1), F.regexp_extract_all(text, p, F.lit(0))]
    if rule.group:
        found.append(F.regexp_extract_all(text, p, F.lit(rule.group)))

    def one(z: Column, i: Column) -> Column:
        return F.struct(F.lit(rule.key).alias("rule"), i.cast("int").alias("n"), F.char_length(z.getField("0")).alias("gap"),
                        F.char_length(z.getField("1")).alias("len"), F.octet_length(z.getField("0")).alias("gap_bytes"), F.octet_length(z.getField("1")).alias("len_bytes"),
                        (F.char_length(z.getField("2" if rule.group else "1")) >= rule.least).alias("good"))

    every = F.transform(F.arrays_zip(*found), one)
    return F.when(text.rlike(rule.pattern), F.filter(every, lambda h: h["len"].isNotNull()))


class BlobLedger:
    """Scanned (blob, rule version) pairs and their hits, one folder per batch."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or run_folder(spark, "blob-ledger")

    def _exists(self) -> bool:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(path)) and len(fs.listStatus(path)) > 0

    def table(self) -> DataFrame:
        if not self._exists():
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", "true").parquet(self.folder)

    def scan(self, versions: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
        """Scan what the ledger lacks of these versions' blobs; append it as one batch."""
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        blobs = versions.select(F.sha2(text, 256).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
        if self._exists():
            seen = self.table().select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
            blobs = blobs.join(seen, "blob", "left")
        else:
            blobs = blobs.withColumn("seen", F.lit(None).cast("array<string>"))
        wanted = F.array(*[F.lit(r.key) for r in rules])
        todo = blobs.select("blob", "text", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))).alias("rules")).filter(F.size("rules") > 0)
        nothing = F.array().cast(_HITS)
        hits = F.concat(*[F.coalesce(F.when(F.array_contains("rules", r.key), _hits(F.col("text"), r)), nothing) for r in rules])
        todo.select("blob", "rules", hits.alias("hits")).write.parquet(f"{self.folder}/batch-{uuid.uuid4().hex}")

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob, rule_no, kind, start, end, first_byte, end_byte) of the given rule versions;
        code points and bytes, ends exclusive.  A blob that the ledger holds twice counts once."""
        keys = [r.key for r in rules]
        hit = (self.table().filter(F.size("hits") > 0).select("blob", F.explode("hits").alias("h"))
               .select("blob", "h.*").filter(F.col("rule").isin(keys)).repartition("blob", "rule").dropDuplicates(["blob", "rule", "n"]))
        so_far = Window.partitionBy("blob", "rule").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
        number = reduce(lambda c, x: c.when(F.col("rule") == x[1].key, x[0]), enumerate(rules), F.when(F.lit(False), -1))
        kind = F.regexp_replace("rule", "@.*", "")
        placed = (hit.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(so_far))
                  .withColumn("end_byte", F.sum(F.col("gap_bytes").cast("long") + F.col("len_bytes")).over(so_far)))
        return placed.filter("good").select("blob", number.alias("rule_no"), kind.alias("kind"), (F.col("end") - F.col("len")).alias("start"), "end",
                                            (F.col("end_byte") - F.col("len_bytes")).alias("first_byte"), "end_byte")


def scan_versions(versions: DataFrame, ledger: BlobLedger, text_col: str = "text", columns: tuple[str, ...] = ("doc_id",),
                  rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``columns`` of every version with its ``blob`` and ``found``: an array of
    (start, rule_no, kind, end) sorted by start and rule, null where nothing was found."""
    ledger.scan(versions, text_col, rules)
    by_blob = ledger.findings(rules).groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "rule_no", "kind", "end"))).alias("found"))
    paths = versions.select(*[f"`{c}`" for c in columns], blob_id(F.col(text_col)).alias("blob"))
    return paths.join(by_blob, "blob", "left").select(*[f"`{c}`" for c in columns], "blob", "found")


def spans_text(found: Column, base_only: bool = False) -> Column:
    """``kind:start:end`` of the findings, comma-joined; empty where there are none."""
    if base_only:
        found = F.filter(found, lambda f: f["rule_no"] < len(BASE_RULES))
    return F.coalesce(F.array_join(F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ","), F.lit(""))


def count_kind(found: Column, kind: str) -> Column:
    return F.coalesce(F.size(F.filter(found, lambda f: f["kind"] == kind)), F.lit(0)).cast("long")


def redacted(docs: DataFrame, ledger: BlobLedger, text_col: str = "text", chars_col: str | None = "n_chars",
             rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with every finding replaced by ``[SECRET]`` (overlapping ones by
    one mark); ``chars_col`` follows where a text changed."""
    ledger.scan(docs, text_col, rules)
    before = Window.partitionBy("blob").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("blob").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    islands = (ledger.findings(rules).select("blob", "start", "end", "first_byte", "end_byte")
               .withColumn("new", (F.col("start") > F.coalesce(F.max("end").over(before), F.lit(-1))).cast("int"))
               .withColumn("island", F.sum("new").over(upto))
               .groupBy("blob", "island").agg(F.min("first_byte").alias("start"), F.max("end_byte").alias("end"))
               .groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts")))
    plain, name = numbered(docs)
    own = name[text_col]
    joined = plain.withColumn("own_blob", blob_id(F.col(own))).join(islands, F.col("own_blob") == F.col("blob"), "left")
    text, cuts = F.col(own), F.col("cuts")
    raw = text.cast("binary")
    # the bytes between two findings, then a mark; the tail after the last one
    last = lambda i: F.coalesce(F.get(cuts, i - 1)["end"], F.lit(0)).cast("int")
    parts = F.transform(cuts, lambda c, i: F.concat(F.substring(raw, last(i) + 1, (c["start"] - last(i)).cast("int")).cast("string"), F.lit("[SECRET]")))
    tail = F.substring(raw, F.element_at(cuts, -1)["end"].cast("int") + 1, F.octet_length(text)).cast("string")
    out = joined.withColumn(own, F.when(cuts.isNull() | text.isNull(), text).otherwise(F.concat(F.array_join(parts, ""), tail)))
    if chars_col in docs.columns:
        chars = name[chars_col]
        out = out.withColumn(chars, F.when(cuts.isNull(), F.col(chars)).otherwise(F.char_length(own).cast(docs.schema[chars_col].dataType)))
    return out.select(*[F.col(name[c]).alias(c) for c in docs.columns])
