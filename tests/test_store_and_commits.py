"""Symbol store: what a read touches; commit log: half-written batches, replays, compaction."""

import re

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tickforge.session import list_folder, remove_folder
from tickforge.sources import store, tables
from tickforge.streaming import streams


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store"))
    t = tables.ticks(spark, SF001).drop("date")
    t = t.unionByName(t.limit(3).withColumn("symbol", F.lit(None).cast("string"))).unionByName(t.limit(1).withColumn("symbol", F.lit("it's 'odd'")))
    store.write_store(t, path)
    return path, t


def test_a_symbol_is_read_alone(spark, stored):
    path, t = stored
    for s in ("CLICK Index", "it's 'odd'", "none such"):
        got = store.read_symbol(spark, path, s)
        assert got.columns == t.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, t.filter(F.col("symbol") == F.lit(s)).collect()))
        plan = got._jdf.queryExecution().toString()
        scan = re.search(r"FileScan parquet .*", plan[plan.index("== Physical Plan =="):])[0]
        number = store.bucket_of(F.lit(s))
        bucket = spark.range(1).select(number.alias("b")).first().b
        assert f"(symbol_bucket#" in scan and f" = {bucket})" in re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan)[1]
        assert "EqualTo(symbol," in scan
    files = store.read_symbol(spark, path, "CLICK Index").select(F.input_file_name().alias("f")).distinct().collect()
    every = spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().count()
    assert all("symbol_bucket=" in r.f for r in files) and len(files) < every


def test_a_time_is_pushed_too_and_rows_are_in_order(spark, stored):
    path, t = stored
    times = sorted(r.ts for r in t.filter("symbol = 'CLICK Index'").collect())
    got = store.read_symbol(spark, path, "CLICK Index", since=F.lit(times[-5]).cast("timestamp_ntz"))
    assert got.count() == 5 and "GreaterThanOrEqual(ts," in got._jdf.queryExecution().toString()
    inside = spark.read.parquet(path).withColumn("f", F.input_file_name()).withColumn("i", F.monotonically_increasing_id())
    rows = {}
    for r in inside.filter("symbol is not null").orderBy("i").collect():
        rows.setdefault(r.f, []).append((r.symbol, r.ts))
    assert all(x == sorted(x) for x in rows.values())


def numbers(spark, n, start=0):
    return spark.range(start, start + n).select("id", (F.col("id") % 3).alias("part"))


def read(spark, path):
    return sorted(r.id for r in streams.read_out(numbers(spark, 1), path).collect())


def test_only_committed_batches_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read(spark, path) == []
    streams.committed_write(numbers(spark, 5), path, 0)
    streams.committed_write(numbers(spark, 5, 5), path, 1)
    numbers(spark, 7, 100).write.parquet(f"{path}/batch_id=2")  # written, then the driver was lost
    assert read(spark, path) == list(range(10))
    remove_folder(spark, f"{path}/{streams.COMMITS}/1")  # a replay has begun
    assert read(spark, path) == list(range(5))
    streams.committed_write(numbers(spark, 5, 5), path, 1)
    streams.committed_write(numbers(spark, 3, 10), path, 2)
    assert read(spark, path) == list(range(13))


def test_compaction_keeps_every_row_once(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(6):
        streams.committed_write(numbers(spark, 10, 10 * k), path, k, ["part"])
    assert streams.compact(spark, path, partition_by=["part"]) == 4
    assert read(spark, path) == list(range(60)) and sorted(x for x in list_folder(spark, path) if x.startswith("batch")) == ["batch_id=5"]
    streams.committed_write(numbers(spark, 10, 50), path, 5, ["part"])  # the newest batch may still be replayed
    streams.committed_write(numbers(spark, 10, 60), path, 6, ["part"])
    # interrupted between the new folder's marker and the removals: nothing counts twice
    keep = streams.remove_folder
    streams.remove_folder = lambda *a: None
    try:
        assert streams.compact(spark, path, partition_by=["part"]) == 5
    finally:
        streams.remove_folder = keep
    assert read(spark, path) == list(range(70))
    streams.committed_write(numbers(spark, 10, 70), path, 7, ["part"])
    assert streams.compact(spark, path, partition_by=["part"]) == 6
    assert read(spark, path) == list(range(80)) and sorted(list_folder(spark, f"{path}/{streams.COMMITS}")) == ["7", "upto-6"]
    assert streams.compact(spark, path) is None


def test_observed_counts_scan_nothing_again(spark):
    from tickforge.catalog import QUERIES
    got = QUERIES["csv_roundtrip_counts"](spark, SF001)
    assert "FileScan" not in got._jdf.queryExecution().toString()
    assert got.first() == QUERIES["reshape_counts"](spark, SF001).first()
