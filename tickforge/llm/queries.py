"""Registered queries of the training-data operators and their DuckDB twins.

Each ``opN_`` query is a thin digest over its operator, run with production
parameters over the whole table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import bpe, chat, conversation_repair, decontaminate, langid, line_dedup, quality, resample, secret_scan, simhash, toxicity, url_filter, warc
from tickforge.llm.common import read_table

VOCABULARY = "byte_bpe_50k.json"

# The rules of op3.
URL_RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(read_table(spark, sf_dir, "conversations"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"), URL_RULES)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages"))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_versions(read_table(spark, sf_dir, "documents"), secret_scan.BlobLedger(spark))
    spans = F.col("found")
    return found.select("doc_id", *[secret_scan.count_kind(spans, r.kind).alias(f"n_{r.kind}") for r in secret_scan.BASE_RULES],
                        F.sha2(secret_scan.spans_text(spans, base_only=True), 256).alias("base_sha256"), secret_scan.spans_text(spans).alias("spans"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    judged = langid.identify(docs.withColumn("held_out", langid.held_out()), langid.learn_held_out(docs), columns=("doc_id", "held_out"))
    return judged.select("doc_id", "held_out", "lang_pred", "score")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.kept_lines(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_table(spark, sf_dir, "conversations")
    repair = conversation_repair.Repair(conversation_repair.damaged(given), F.col("copies"))
    every = given.select(F.col("conv_id").alias("c")).distinct()
    told = repair.report()
    said = conversation_repair.digests(repair.turns()).withColumnRenamed("conv_id", "d")
    whole = (every.join(told, F.col("c").eqNullSafe(F.col("conv_id")), "left").join(said, F.col("c").eqNullSafe(F.col("d")), "left"))
    zero = [F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return whole.select(F.col("c").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_chat_formatting, op2_benchmark_decontamination, op3_url_filters, op4_quality_rules, op5_simhash_near_dedup,
    op6_toxicity, op7_warc, op8_secret_scans, op9_bpe, op10_language_id, op11_line_dedup,
    op12_importance_resampling, op13_conversation_repair)}

_OP3 = f"""
WITH rules(h, p, verdict) AS (VALUES {', '.join(str(tuple(r)) for r in URL_RULES)}),
u AS (SELECT row_number() OVER () AS k, page_id, coalesce(url, '') AS url FROM pages),
s AS (SELECT k, page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
             regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM u),
f AS (SELECT s.*, h || p AS rule, verdict,
             row_number() OVER (PARTITION BY k ORDER BY len(string_split(h, '.')) DESC NULLS LAST, length(p) DESC) AS nth
      FROM s LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f WHERE nth = 1
"""


def _op8() -> str:
    """Matches by RE2; their places by splitting at them, as lists of lengths."""
    # RE2 repeats a group without recursion and has no lookarounds
    twins = {"private_key": "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"}

    def spans(number: int, rule: secret_scan.Rule) -> str:
        p = twins.get(rule.kind, rule.pattern).replace("'", "''")
        group = f"regexp_extract_all(txt, '{p}', {rule.group})"
        return f"""
SELECT k, {number} AS number, '{rule.kind}' AS kind, unnest(list_transform(range(1, len(m) + 1), lambda i: struct_pack(
         s := CAST(list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT),
         n := CAST(length(m[i]) AS BIGINT), g := length(g[i])))) AS h
FROM (SELECT k, regexp_extract_all(txt, '{p}', 0) AS m, {group} AS g, string_split_regex(txt, '{p}') AS pieces FROM d WHERE regexp_matches(txt, '{p}'))"""

    rules = secret_scan.RULES
    least = " OR ".join(f"(number = {i} AND h.g >= {r.least})" for i, r in enumerate(rules))
    base = len(secret_scan.BASE_RULES)
    one = "kind || ':' || CAST(h.s AS VARCHAR) || ':' || CAST(h.s + h.n AS VARCHAR)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce("text", '') AS txt FROM documents),
f AS ({' UNION ALL '.join(spans(i, r) for i, r in enumerate(rules))}),
a AS (SELECT k, {', '.join(f"count(*) FILTER (number = {i}) AS n_{r.kind}" for i, r in enumerate(secret_scan.BASE_RULES))},
             string_agg({one}, ',' ORDER BY h.s, number) FILTER (number < {base}) AS base_spans, string_agg({one}, ',' ORDER BY h.s, number) AS spans
      FROM f WHERE {least} GROUP BY k)
SELECT doc_id, {', '.join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secret_scan.BASE_RULES)},
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (k)
"""


ORACLES = {
    "op1_chat_formatting": chat.ORACLE,
    "op3_url_filters": _OP3,
    "op7_warc": warc.ORACLE,
    "op8_secret_scans": _op8(),
    "op11_line_dedup": line_dedup.ORACLE,
    "op12_importance_resampling": resample.ORACLE,
    "op13_conversation_repair": conversation_repair.ORACLE,
}
