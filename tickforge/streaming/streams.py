"""Structured Streaming forms of the tick -> feature -> signal chain.

* Row-level features and stand-in signals are the batch expressions on a
  stream: no state, no shuffle.
* ``keyed`` (own module): indicators and price changes from a bounded ring of
  prices per symbol in the state store.
* ``run_with_history``: series operators on a stream.  Each micro-batch is
  joined by the newest rows of every key that earlier batches left in a state
  table, and goes through the *batch* operator (windows, chunked for hot keys,
  no Python); then the newest rows become the next state.  Output and state
  are one ``batch_id=<n>`` folder each, written with overwrite, and batch n
  reads the state of the batch before it: a replayed batch replaces its own
  output (idempotent).
* ``price_change_stream``: the same for one lag with keyed state
  (``applyInPandasWithState``); first tick of a symbol gives 0.0.
* ``table_sink``: ``foreachBatch`` append into a parquet table with a commit log:
  a batch counts once its marker stands in ``_commits``, which a replay takes away
  before it writes again.  ``read_out`` reads the marked batches only, from one
  listing; ``compact`` rewrites many small ones as one.

Within a micro-batch the ticks of a symbol are processed in (ts, event_id)
order; across batches, in arrival order.  Micro-batches are bounded by
``MAX_BATCH_BYTES`` of input files.
"""

from __future__ import annotations

import uuid
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.indicators import HISTORY, newest, with_indicators
from ..plans.sequence import REAL, sequence
from ..session import list_folder, path_kind, remove_folder, scratch_path, touch
from ..sources.files import kafka_sink_options, to_wire

MAX_BATCH_BYTES = 1 << 30


def tick_stream(spark: SparkSession, sf_dir: str, table: str = "events", max_bytes: int = MAX_BATCH_BYTES) -> DataFrame:
    """File-source stream over one parquet table: a folder of part files or a single file."""
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    kind = path_kind(spark, path)
    if kind is None:
        raise FileNotFoundError(f"no table {path}")
    r = spark.readStream.schema(spark.read.parquet(path).schema).option("maxBytesPerTrigger", max_bytes)
    if kind == "folder":
        return r.parquet(path)
    return r.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)


# ------------------------------------------------------------ price change
PRICE_CHANGE_OUT = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("price_change", T.DoubleType()),
])
PRICE_CHANGE_STATE = T.StructType([T.StructField("last_price", T.DoubleType())])


def _price_change(key, pdfs, state):
    pdf = pd.concat(list(pdfs), ignore_index=True).sort_values(["ts", "event_id"], kind="stable")
    last = state.get[0] if state.exists else None
    prev = pdf["price"].shift(1)
    if last is not None:
        prev.iloc[0] = last
    change = (pdf["price"] - prev).fillna(0.0)
    state.update((float(pdf["price"].iloc[-1]),))
    yield pd.DataFrame({"symbol": pdf["symbol"], "ts": pdf["ts"], "event_id": pdf["event_id"],
                        "price": pdf["price"], "price_change": change})


def price_change_stream(ticks: DataFrame) -> DataFrame:
    return ticks.select("symbol", "ts", "event_id", "price").groupBy("symbol").applyInPandasWithState(
        _price_change, PRICE_CHANGE_OUT, PRICE_CHANGE_STATE, "append", GroupStateTimeout.NoTimeout)


# --------------------------------------------------- series with a state table
STATE_SEEN = "_seen"
OWN = "own"


def run_with_history(stream: DataFrame, name: str, rows: int, compute, keys=("symbol",), order=("ts", "event_id"),
                     checkpoint: str | None = None, table: str | None = None, state: str | None = None, processing_time: str | None = None):
    """Start ``compute`` over a stream with ``rows`` rows of history per key;
    returns (query, table path).

    ``compute(frame, keys, order)`` gets the batch's rows (``own`` true) and the
    history before them (``own`` false, first in order) and returns columns of
    the batch operator with ``own`` kept; a ``tick_number`` it gives is counted
    within that frame and moved on by the rows seen before.  The stream drains and
    stops, or goes on every ``processing_time``.
    """
    spark = stream.sparkSession
    run = uuid.uuid4().hex
    keys, order = list(keys), list(order)
    table = table or scratch_path(spark, f"tables/{name}-{run}")
    state = state or scratch_path(spark, f"states/{name}-{run}")
    checkpoint = checkpoint or scratch_path(spark, f"streams/{name}-{run}")
    fields = stream.columns

    def write(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        ids = [int(x.split("=")[1]) for x in list_folder(s, state) if x.startswith("batch_id=")]
        before = max((i for i in ids if i < batch_id), default=None)
        cur = batch.withColumn(OWN, F.lit(True))
        if before is None:
            frame = cur
            old = None
        else:
            kept = s.read.parquet(f"{state}/batch_id={before}")
            old = kept.groupBy(*keys).agg(F.max(STATE_SEEN).alias(STATE_SEEN), F.count(F.lit(1)).alias("_held"))
            frame = cur.unionByName(kept.select(*fields).withColumn(OWN, F.lit(False)))
        in_order = [OWN, *order]
        out = compute(frame, keys, in_order).filter(OWN).drop(OWN)
        if old is not None and "tick_number" in out.columns:
            out = (out.join(old, keys, "left").withColumn("tick_number", F.col("tick_number") + F.coalesce(F.col(STATE_SEEN) - F.col("_held"), F.lit(0)))
                   .drop(STATE_SEEN, "_held"))
        committed_write(out, table, batch_id)
        counts = cur.groupBy(*keys).agg(F.count(F.lit(1)).alias("_new"))
        if old is not None:
            counts = counts.join(old, keys, "full").select(*keys, (F.coalesce("_new", F.lit(0)) + F.coalesce(STATE_SEEN, F.lit(0))).alias("_new"))
        held = newest(frame, rows, keys, in_order).join(counts.withColumnRenamed("_new", STATE_SEEN), keys)
        held.select(*fields, STATE_SEEN).write.mode("overwrite").parquet(f"{state}/batch_id={batch_id}")
        for i in ids:  # a replay of this batch or the next one reads no older state
            if before is not None and i < before:
                remove_folder(s, f"{state}/batch_id={i}")

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, processing_time).start(), table


def _trigger(writer, processing_time: str | None):
    return writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)


def indicators_of(frame: DataFrame, keys: list, order: list) -> DataFrame:
    return with_indicators(frame, keys, order)


def price_changes_of(frame: DataFrame, keys: list, order: list) -> DataFrame:
    s = sequence(frame, keys, order, before=1)
    change = F.coalesce(F.col("price") - F.lag("price", 1).over(s.window), F.lit(0.0))
    return s.positioned().withColumn("price_change", change).filter(REAL).select(*frame.columns, "price_change")


def indicator_table(stream: DataFrame, name: str = "indicators", **kw):
    return run_with_history(stream, name, HISTORY - 1, indicators_of, **kw)


def price_change_table(stream: DataFrame, name: str = "price_change", **kw):
    return run_with_history(stream, name, 1, price_changes_of, **kw)


# ------------------------------------------------------------------ sinks
COMMITS = "_commits"
COMPACTED = "_compacted"


def committed_write(batch: DataFrame, path: str, batch_id: int, partition_by: list | None = None) -> None:
    """Write a batch's folder (a replay replaces it) and then its marker."""
    spark, marker = batch.sparkSession, f"{path}/{COMMITS}/{batch_id}"
    remove_folder(spark, marker)
    w = batch.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{path}/batch_id={batch_id}")
    touch(spark, marker)


def committed(spark: SparkSession, path: str) -> tuple[int | None, list[int]]:
    """(last batch of the newest compaction, committed batches after it)."""
    names = list_folder(spark, f"{path}/{COMMITS}")
    upto = max((int(n.removeprefix("upto-")) for n in names if n.startswith("upto-")), default=None)
    return upto, sorted(int(n) for n in names if n.isdigit() and (upto is None or int(n) > upto))


def _rows(spark: SparkSession, path: str, upto: int | None, batches: list[int]) -> DataFrame | None:
    parts = [] if upto is None else [spark.read.parquet(f"{path}/{COMPACTED}/upto={upto}")]
    if batches:
        parts.append(spark.read.option("basePath", path).parquet(*[f"{path}/batch_id={n}" for n in batches]).drop("batch_id"))
    return reduce(DataFrame.unionByName, parts) if parts else None


def compact(spark: SparkSession, path: str, keep: int = 1, partition_by: list | None = None) -> int | None:
    """Rewrite all committed batches but the newest ``keep`` (a restart may replay the
    newest one) as one folder, sized by the adaptive plan; returns the last batch in it.

    The new folder counts from its own marker on; only then are the folders that
    it replaces removed, so a crash at any point leaves every row readable once.
    Readers that began before may need to read again."""
    before, batches = committed(spark, path)
    old = batches[:len(batches) - keep] if keep else batches
    if not old:
        return None
    upto = old[-1]
    w = _rows(spark, path, before, old).hint("rebalance").write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{path}/{COMPACTED}/upto={upto}")
    names = list_folder(spark, f"{path}/{COMMITS}")
    touch(spark, f"{path}/{COMMITS}/upto-{upto}")
    for n in names:  # what an earlier, interrupted run has left goes too
        if (n.isdigit() and int(n) <= upto) or (n.startswith("upto-") and n != f"upto-{upto}"):
            remove_folder(spark, f"{path}/batch_id={n}" if n.isdigit() else f"{path}/{COMPACTED}/upto={n.removeprefix('upto-')}")
            remove_folder(spark, f"{path}/{COMMITS}/{n}")
    return upto


def table_sink(path: str, partition_by: list | None = None):
    """foreachBatch function: executor-side parquet write, one committed folder per batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        committed_write(batch, path, batch_id, partition_by)
    return write


def run_to_table(stream: DataFrame, name: str, checkpoint: str | None = None, partition_by: list | None = None,
                 processing_time: str | None = None, table: str | None = None):
    """Start a stream into a parquet table (by default under the shared checkpoint
    folder); returns (query, table path).  It drains what is available and stops,
    or goes on every ``processing_time``."""
    spark = stream.sparkSession
    run = uuid.uuid4().hex[:12]
    table = table or scratch_path(spark, f"tables/{name}-{run}")
    w = stream.writeStream.foreachBatch(table_sink(table, partition_by)).option("checkpointLocation", checkpoint or scratch_path(spark, f"streams/{name}-{run}"))
    return _trigger(w, processing_time).start(), table


def read_out(stream: DataFrame, table: str, schema: T.StructType | None = None) -> DataFrame:
    """The committed batches that a stream has written; empty where none ran."""
    spark = stream.sparkSession
    rows = _rows(spark, table, *committed(spark, table))
    return spark.createDataFrame([], schema or stream.schema) if rows is None else rows


def drain(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over everything available, then read its table."""
    q, table = run_to_table(stream, name)
    q.awaitTermination()
    return read_out(stream, table)


def console_sink(stream: DataFrame, rows: int = 10, processing_time: str = "2 seconds"):
    """Console inspection sink (truncate off)."""
    return (stream.writeStream.format("console").option("truncate", False).option("numRows", rows)
            .trigger(processingTime=processing_time).start())


def kafka_sink(stream: DataFrame, bootstrap: str, topic: str, checkpoint: str, processing_time: str = "2 seconds"):
    """Feature JSON to Kafka (needs the spark-sql-kafka package)."""
    w = to_wire(stream).writeStream.format("kafka")
    for k, v in kafka_sink_options(bootstrap, topic, checkpoint).items():
        w = w.option(k, v)
    return w.trigger(processingTime=processing_time).start()
