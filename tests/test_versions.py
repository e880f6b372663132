"""As-of scoring by model versions: exact borders, more versions than travel at once, hot swap in a running stream."""

import numpy as np
from conftest import SF001
from pyspark.sql import functions as F
from test_streaming import _place, split_events  # noqa: F401

from tickforge import catalog as c
from tickforge.operators import trees as T
from tickforge.plans.sequence import order_number
from tickforge.sources import tables
from tickforge.streaming import versions as V


def constant(value):
    """A model whose margin is ``value`` below price 50 and its opposite above."""
    tree = (np.array([0, -1, -1]), np.array([0, 0, 0]), np.array([0.0, value, -value]))
    return T.BoostedModel(["price"], [[50.0]], [0.0], 0.0, [tree])


def want(rows, known):
    out = {}
    for event, when, price in rows:
        held = [(a, v, up) for a, v, up in known if when is not None and a <= when]
        if not held:
            out[event] = (None, "TRAINING")
            continue
        _, v, up = max(held, key=lambda x: (x[0], x[1]))
        out[event] = (v, "UP" if (price is None or price <= 50) == up else "DOWN")
    return out


def test_borders_nulls_and_many_versions(spark):
    t = tables.clean_ticks(tables.ticks(spark, SF001)).limit(300)
    t = t.unionByName(t.limit(2).withColumns({"ts": F.lit(None).cast("timestamp_ntz"), "event_id": -F.col("event_id") - 1}))
    t = t.withColumn("price", F.when(F.col("event_id") % 10 == 0, F.lit(None)).otherwise(F.col("price"))).cache()
    rows = [(r.event_id, r.when, r.price) for r in t.withColumn("when", order_number(t, "ts")).collect()]
    times = sorted(w for _, w, _ in rows if w is not None)
    registry = V.ModelVersions(spark)
    assert {r.predicted for r in V.score_as_of(t, registry, ["price"]).collect()} == {"TRAINING"}
    known = [(times[20 * k + 10], k + 1, k % 2 == 0) for k in range(12)] + [(times[50], 20, True), (times[-1] + 1e9, 21, True)]
    for a, v, up in known:
        registry.publish(v, a, constant(1.0 if up else -1.0))
    for live in (64, 5, 1):
        got = V.score_as_of(t, registry, ["price"], live=live).collect()
        assert len(got) == len(rows) and {r.event_id: (r.version, r.predicted) for r in got} == want(rows, known)
    t.unpersist()


def test_a_version_published_while_the_stream_runs(spark, split_events, tmp_path):  # noqa: F811
    root, schema = split_events
    src = tmp_path / "in"
    src.mkdir()
    _place(root, src, range(2))
    s = tables.clean_ticks(tables.ticks_from_events(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))))
    all_rows = tables.clean_ticks(tables.ticks(spark, SF001))
    rows = [(r.event_id, r.when, r.price) for r in all_rows.withColumn("when", order_number(all_rows, "ts")).collect()]
    times = sorted(w for _, w, _ in rows)
    registry = V.ModelVersions(spark)
    registry.publish(1, times[100], constant(1.0))
    known = [(times[100], 1, True)]
    q, table = V.score_stream(s, registry, ["price"], "swap", processing_time="100 milliseconds")
    try:
        q.processAllAvailable()
        registry.publish(2, times[700], constant(-1.0))
        known.append((times[700], 2, False))
        _place(root, src, range(2, 4))
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.read.parquet(table).collect()
    assert len(got) == 1000 and {r.event_id: (r.version, r.predicted) for r in got} == want(rows, known)


def test_half_written_versions_do_not_count(spark):
    import os
    registry = V.ModelVersions(spark)
    registry.publish(1, 0.0, constant(1.0))
    registry.publish(2, 1.0, constant(1.0))
    os.remove(f"{registry.folder.removeprefix('file:')}/v2/_SUCCESS")
    assert registry.known() == [(0.0, 1)]


def test_query(spark):
    got = c.QUERIES["stream_model_predictions"](spark, SF001)
    per = {r.version: r["count"] for r in got.groupBy("version").count().collect()}
    assert set(per) == {None, 1, 2, 3} and all(200 <= n <= 300 for n in per.values())
    assert {r.predicted for r in got.filter("version is null").collect()} == {"TRAINING"}
    assert {r.predicted for r in got.filter("version > 0").collect()} == {"UP", "DOWN"}
