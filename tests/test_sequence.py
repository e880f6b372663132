"""The chunked plan gives the plain plan's rows on inputs that are hard to place."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickforge.operators import indicators as ind
from tickforge.plans.sequence import REAL, plain, sequence

BASE = dt.datetime(2024, 1, 1)
ZONE = "spark.sql.session.timeZone"


def ticks(spark, rows, schema="symbol string, price double, ts timestamp_ntz, event_id long"):
    return spark.createDataFrame(rows, schema)


CASES = {
    "nulls": [("S", float(i % 37 + 1), None if i % 10 == 0 else BASE + dt.timedelta(minutes=i), i) for i in range(600)],
    "equal_times": [("S", float(i % 37 + 1), BASE, i) for i in range(1200)],
    "burst": [("S", float(i % 37 + 1), BASE + dt.timedelta(days=0 if i < 900 else i), i) for i in range(1200)],
    "skewed": [("S", float(i % 37 + 1), BASE + dt.timedelta(seconds=i if i < 1100 else i * 100_000), i) for i in range(1200)],
    "null_key": [(None, float(i % 37 + 1), BASE + dt.timedelta(minutes=i), i) for i in range(600)] + [("A", 1.0, BASE, i) for i in range(50)],
    "full_ties": [("S", float(i % 7 + 1), BASE, i // 40) for i in range(800)],
    "all_null_times": [("S", float(i % 37 + 1), None, i) for i in range(600)],
}


@pytest.mark.parametrize("case", list(CASES))
def test_rows_and_ordinals(spark, small_chunks, case):
    df = ticks(spark, CASES[case])
    s = sequence(df, ["symbol"], ["ts", "event_id"], before=99, after=1)
    assert s.chunked
    own = s.positioned().filter(REAL)
    got = sorted((r.symbol or "", r._ord) for r in own.collect())
    want = sorted((r.symbol or "", r._ord) for r in plain(df, ["symbol"], ["ts", "event_id"]).positioned().collect())
    assert got == want
    assert sorted(own.select(*df.columns).collect(), key=str) == sorted(df.collect(), key=str)
    per = s.df.groupBy("symbol", "_chunk").count().agg(F.max("count"), F.count("*")).first()
    if case != "full_ties":
        assert per[0] <= 120 + 100 + 4 * 16  # a chunk, its halo and the rest of the cells at its ends
    assert per[1] > 3


def test_equal_times_are_not_copied(spark, small_chunks):
    for n in (1200, 4800):
        df = ticks(spark, [("S", 1.0, BASE, i) for i in range(n)])
        assert sequence(df, ["symbol"], ["ts", "event_id"], after=1).df.count() <= 1.2 * n


def test_clock_change_in_the_session_zone(spark, small_chunks):
    rows = [("S", float(i % 37 + 1), dt.datetime(2024, 3, 10) + dt.timedelta(minutes=i), i) for i in range(600)]
    old = spark.conf.get(ZONE)
    try:
        spark.conf.set(ZONE, "America/New_York")
        df = ticks(spark, rows)
        out = ind.with_indicators(df)
        assert out.count() == out.select("event_id").distinct().count() == 596
    finally:
        spark.conf.set(ZONE, old)


def test_indicators_with_null_times(spark, small_chunks):
    df = ticks(spark, CASES["nulls"])
    a = {r.event_id: (r.tick_number, r.ema_26) for r in ind.with_indicators(df).collect()}
    b = {r.event_id: (r.tick_number, r.ema_26) for r in ind.with_indicators(df, chunked=False).collect()}
    assert len(a) == 596 and a.keys() == b.keys()
    for k in a:
        assert a[k][0] == b[k][0] and (a[k][1] == pytest.approx(b[k][1]) if b[k][1] is not None else a[k][1] is None)


def test_other_order_types(spark, small_chunks):
    rows = [(1, f"é{i:05d}" if i % 3 else f"a{i:05d}", float("nan") if i % 50 == 0 else i / 3, i) for i in range(700)]
    df = spark.createDataFrame(rows, "k int, name string, x double, n int")
    for order in (["name"], ["x", "n"], ["n"]):
        s = sequence(df, ["k"], order, before=5)
        got = {r.n: r._ord for r in s.positioned().filter(REAL).collect()}
        assert got == {r.n: r._ord for r in plain(df, ["k"], order).positioned().collect()} and s.chunked


def test_no_hot_key_is_one_chunk(spark):
    assert not sequence(ticks(spark, CASES["nulls"]), ["symbol"], ["ts", "event_id"]).chunked
    assert not sequence(ticks(spark, []), ["symbol"], ["ts", "event_id"]).chunked


@pytest.fixture()
def few_chunks(small_chunks, monkeypatch):
    """More than two chunks are placed by ranges."""
    from tickforge.plans import sequence as plan
    monkeypatch.setattr(plan, "MAX_CHUNKS", 2)


@pytest.mark.parametrize("case", list(CASES))
def test_ranges_give_the_same_rows_and_ordinals(spark, few_chunks, case):
    df = ticks(spark, CASES[case] + [("B", 2.0, BASE, i) for i in range(3)]).repartition(3)
    s = sequence(df, ["symbol"], ["ts", "event_id"], before=99, after=1)
    assert s.placed
    own = s.positioned().filter(REAL)
    key = lambda r: (r.symbol or "", r._ord)
    want = plain(df, ["symbol"], ["ts", "event_id"]).positioned()
    assert sorted(map(key, own.collect())) == sorted(map(key, want.collect()))
    assert sorted(own.select(*df.columns).collect(), key=str) == sorted(df.collect(), key=str)
    if case != "full_ties":  # ordinals are those of the order
        assert {(r.symbol, r.event_id, r.ts): r._ord for r in own.collect()} == {(r.symbol, r.event_id, r.ts): r._ord for r in want.collect()}
    halo = s.positioned().filter(~F.col(REAL)).groupBy("symbol", "_chunk").count().agg(F.max("count")).first()[0]
    assert halo <= 100


@pytest.mark.parametrize("case", ["nulls", "burst", "null_key"])
def test_ranges_give_the_same_indicators_and_labels(spark, few_chunks, case):
    from tickforge.operators import learning as ml
    df = ticks(spark, CASES[case])
    cols = ["symbol", "event_id", "tick_number", "sma_20", "ema_26", "macd_signal", "lag_5", "next_price"]
    a, b = (sorted(map(str, ([round(v, 6) if isinstance(v, float) else v for v in r] for r in ind.with_indicators(df, chunked=c, with_next=True).select(*cols).collect()))) for c in (True, False))
    assert a == b and a
    a, b = (ml.next_tick_labels(df, chunked=c) for c in (True, False))
    assert a.columns == b.columns and sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def test_ranges_give_the_same_backtest(spark, few_chunks):
    from conftest import SF001
    from tickforge.catalog import QUERIES
    from tickforge.oracle_sql import ORACLES
    import sys
    sys.path.insert(0, "tools")
    from tools.compare import compare, duck
    for name in ("backtest_metrics", "backtest_trades", "indicators_full", "sequential_split"):
        got = compare(spark, duck(SF001), name, QUERIES[name], ORACLES[name], SF001)
        assert got.startswith("OK"), got


def test_short_chunks_reach_over_several_neighbours(spark, monkeypatch):
    """Chunks shorter than the halo (uneven ranges): copies go to all chunks that need them."""
    from tickforge.plans import sequence as plan
    df = ticks(spark, [("S", float(i), BASE + dt.timedelta(minutes=i), i) for i in range(60)])
    s = plan.ranged(df, ["symbol"], ["ts", "event_id"], before=9, after=4, chunk_rows=3, parts=20)
    w = s.window
    x = s.positioned().withColumns({"a": F.lag("event_id", 9).over(w), "b": F.lead("event_id", 4).over(w)}).filter(REAL)
    got = {r.event_id: (r.a, r.b, r._ord) for r in x.collect()}
    assert got == {i: (i - 9 if i >= 9 else None, i + 4 if i < 56 else None, i) for i in range(60)}


def test_more_chunks_than_a_broadcast_would_bear(spark):
    """Chunk rows stay as given however many chunks there are."""
    n = 4200 * 2
    df = spark.range(n).select(F.lit("S").alias("symbol"), F.col("id").cast("double").alias("price"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), F.col("id").alias("event_id"))
    s = sequence(df, ["symbol"], ["ts", "event_id"], before=1, chunk_rows=2)
    assert s.placed and s.chunk_rows == 2
    x = s.positioned().withColumn("before", F.lag("event_id", 1).over(s.window)).filter(REAL)
    bad = x.filter((F.col("_ord") != F.col("event_id")) | ~F.col("before").eqNullSafe(F.when(F.col("event_id") > 0, F.col("event_id") - 1))).count()
    assert bad == 0 and x.count() == n
    assert s.df.filter(REAL).groupBy("_chunk").count().agg(F.count("*"), F.max("count")).first()[0] > 4096
