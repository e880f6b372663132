"""Corpus pipeline over the documents table: five operators, one after the other.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir),
works on all rows that its predecessor kept and returns a DataFrame, which is
written as Parquet and read again as the next one's docs.  All but the last
return the columns of documents.

1. Language ID drops documents whose language cannot be told.
2. SimHash near-dedup keeps one document of each group.
3. Benchmark decontamination drops documents that hold a benchmark item.
4. Secret scans replace secrets in the texts (and set n_chars of those).
5. BPE encodes, decodes and digests what is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickforge.llm import bpe, decontaminate, langid, secret_scan, simhash
from tickforge.llm.common import read_table, run_folder, written

VOCABULARY = "byte_bpe_50k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs, langid.learn_held_out(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs, secret_scan.BlobLedger(spark))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secrets),
    ("bpe", encoding),
]

# Profiles, fingerprints, the SVD and BPE have no SQL form: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written to the shared folder."""
    folder = run_folder(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"{folder}/{k}-{name}")
    return docs
