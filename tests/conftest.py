import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tickforge.session import build_session
    ckpt = tempfile.mkdtemp(prefix="tickforge-test-ckpt-")
    s = build_session("local[4]", shuffle_partitions=8, extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def small_chunks(spark):
    """Force hot-key chunking on tiny data (restored afterwards)."""
    from tickforge.session import CHUNK_ROWS_KEY, FINE_BUCKETS_KEY
    old = spark.conf.get(CHUNK_ROWS_KEY, None)
    spark.conf.set(CHUNK_ROWS_KEY, "120")
    spark.conf.set(FINE_BUCKETS_KEY, "8")
    yield 120
    if old is None:
        spark.conf.unset(CHUNK_ROWS_KEY)
    else:
        spark.conf.set(CHUNK_ROWS_KEY, old)
    spark.conf.unset(FINE_BUCKETS_KEY)


def series_frame(spark, rows):
    """rows: (symbol, i, price[, label...]) -> tick-like frame ordered by i."""
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    data = [(r[0], float(r[2]) if r[2] is not None else None, base + dt.timedelta(minutes=int(r[1])), int(r[1]))
            for r in rows]
    return spark.createDataFrame(data, "symbol string, price double, ts timestamp_ntz, event_id long")
