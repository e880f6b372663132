"""Batch / stream parity over several micro-batches, and restart from the checkpoint."""

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tickforge.operators import indicators as ind
from tickforge.sources import tables
from tickforge.streaming import streams


@pytest.fixture(scope="module")
def split_events(spark, tmp_path_factory):
    """events of sf0.001 rewritten as 4 time-ordered files (one per batch)."""
    root = tmp_path_factory.mktemp("events_split")
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    bounds = ev.selectExpr("percentile_approx(event_id, array(0.25, 0.5, 0.75)) AS q").first()["q"]
    edges = [-1, *bounds, 1 << 62]
    for i in range(4):
        part = ev.filter((F.col("event_id") > edges[i]) & (F.col("event_id") <= edges[i + 1]))
        part.coalesce(1).write.parquet(str(root / f"part{i}"))
    return root, ev.schema


def _place(root, src, parts):
    """Copy part files into the source folder with increasing modification
    times (the file source orders new files by modification time)."""
    import glob
    import os
    import shutil
    import time
    base = time.time() - 1000
    for i in parts:
        dst = src / f"{i:02d}.parquet"
        shutil.copy(glob.glob(str(root / f"part{i}" / "*.parquet"))[0], dst)
        os.utime(dst, (base + 10 * i, base + 10 * i))


def test_indicator_stream_parity_multi_batch(spark, split_events, tmp_path):
    root, schema = split_events
    src = tmp_path / "in"
    src.mkdir()
    _place(root, src, range(4))
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    ticks = tables.clean_ticks(tables.ticks_from_events(s))
    q, table = streams.indicator_table(ticks, "parity")
    q.awaitTermination()
    assert q.lastProgress is not None
    got = spark.read.parquet(table)
    assert got.select("batch_id").distinct().count() == 4
    batch = ind.with_indicators(tables.clean_ticks(tables.ticks(spark, SF001)), chunked=False)
    cols = ["symbol", "event_id", "tick_number", "sma_20", "ema_26", "rsi_14", "macd_signal", "volatility_20"]
    a = sorted(got.select(*cols).collect())
    b = sorted(batch.select(*cols).collect())
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for c in cols:
            if isinstance(y[c], float):
                assert x[c] == pytest.approx(y[c], rel=1e-9, abs=1e-9), (c, x, y)
            else:
                assert x[c] == y[c]


def test_price_change_restart(spark, split_events, tmp_path):
    """Stop after two files, resume from the checkpoint with all four."""
    root, schema = split_events
    src = tmp_path / "in"
    src.mkdir()
    ckpt = str(tmp_path / "ckpt")
    out = str(tmp_path / "out")

    def run():
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
        st = streams.price_change_stream(tables.clean_ticks(tables.ticks_from_events(s)))
        q = (st.writeStream.foreachBatch(streams.table_sink(out)).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()

    _place(root, src, range(2))
    run()
    _place(root, src, range(2, 4))
    run()
    got = spark.read.parquet(out)
    assert got.count() == 1000
    w = __import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("symbol").orderBy("ts", "event_id")
    ref = tables.clean_ticks(tables.ticks(spark, SF001)).withColumn(
        "exp", F.coalesce(F.col("price") - F.lag("price").over(w), F.lit(0.0)))
    bad = got.join(ref, ["symbol", "event_id"]).filter(F.abs(F.col("price_change") - F.col("exp")) > 1e-9).count()
    assert bad == 0


def test_folder_table_missing_and_empty_stream(spark, tmp_path):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ev.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    got = streams.drain(tables.clean_ticks(tables.ticks_from_events(streams.tick_stream(spark, str(tmp_path)))), "folder")
    assert got.count() == ev.count()
    with pytest.raises(FileNotFoundError):
        streams.tick_stream(spark, str(tmp_path), "none")
    empty = tmp_path / "empty"
    ev.limit(0).write.parquet(str(empty / "events.parquet"))
    s = tables.clean_ticks(tables.ticks_from_events(streams.tick_stream(spark, str(empty))))
    assert streams.drain(s, "empty").count() == 0
    from tickforge.catalog import QUERIES
    assert QUERIES["stream_indicators"](spark, str(empty)).count() == 0
