"""Skew-safe sequencing of keyed, ordered series.

Every series operator of the library (indicators, labels, backtests) needs,
for each row, a bounded look-back (at most 100 rows) or look-ahead (1 row)
inside its key, plus a per-key ordinal.  The straightforward plan,
``Window.partitionBy(key).orderBy(order)``, puts a whole key into one task;
with few symbols and one of them holding a third of all ticks that is one
task per symbol over terabytes.

``sequence`` cuts every key with more than C rows into chunks of exactly C
consecutive rows and ships every chunk with copies of the ``before`` rows
preceding it and the ``after`` rows following it (the *halo*).  Window
functions then run over ``(key, _chunk)`` partitions of bounded size and give,
on the chunk's own rows, exactly the values of the per-key window.

Placement.  A *path* of small integers places a row in its key's order: level
0 cuts the key's range of the first order column into equal steps; a cell that
is still too full is cut again, over its own range of the first order column
or, where all its rows share one value of it, of the second one, up to
``LEVELS`` times.  Null comes before all values and NaN after them, as the
window sorts them; numbers that place a value are monotone in it whatever its
type or the session's time zone.  Counts per path and their prefix sums give
each cell's ordinals, hence the chunks that it overlaps.

The placement tables are built when the plan is built, by one narrow scan per
level (keys and two order columns, partial aggregation), and written once to
the shared folder; all uses read them from there.  They have at most about
``fine_buckets * MAX_CHUNKS`` rows: that bound, not an estimate, is why they are
broadcast.  Inputs of more than ``MAX_CHUNKS`` chunks are placed by ``ranged``
instead, where nothing is broadcast: C stays what it is at any input size.

The main pass is one scan, the broadcast joins, and **one hash shuffle on
(key, _chunk)**.  Inside a chunk a row's per-key ordinal is the first cell's
ordinal plus its row number, because whole cells travel together; rows that
tie on the whole order are told apart by a hash of all columns.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import chunk_rows as conf_chunk_rows
from ..session import fine_buckets as conf_fine_buckets
from ..session import scratch_path

CHUNK = "_chunk"
BUCKET_START = "_cb"
ORD = "_ord"
REAL = "_real"
TIE = "_tie"
PLACE, AT = "_place", "_at"
RANGED = "ranged"

MAX_CHUNKS = 4096
LEVELS = 4


def order_number(df: DataFrame, col: str) -> Column:
    """A double monotone in ``col`` (null stays null); equal values get equal numbers."""
    dt = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dt, T.TimestampNTZType):  # by its fields: no session zone involved
        day = F.unix_date(c.cast("date")).cast("double") * 86_400
        second = F.hour(c) * 3600 + F.minute(c) * 60 + F.date_part(F.lit("SECOND"), c).cast("double")
        return (day + second) * 1e6
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dt, (T.StringType, T.BinaryType)):  # its first six bytes
        raw = c.cast("binary")
        return F.when(c.isNotNull(), F.conv(F.rpad(F.hex(F.substring(raw, 1, 6)), 12, "0"), 16, 10).cast("double"))
    if isinstance(dt, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    return F.when(c.isNotNull(), F.lit(0.0))  # other types are ordered by the window only


@dataclass
class Sequenced:
    """A sequenced frame: ``df`` carries ``_chunk`` and ``_cb`` (and ``_tie`` when chunked)."""

    df: DataFrame
    keys: list
    order: list
    chunk_rows: int
    chunked: bool = True
    placed: bool = False  # by ``ranged``: rows have a place in the whole order

    @property
    def form(self) -> str | bool:
        """False: keys are whole; else how they are cut (``RANGED``: into any number of chunks)."""
        return RANGED if self.placed else self.chunked

    @property
    def window(self) -> WindowSpec:
        if self.placed:
            return Window.partitionBy(*self.keys, CHUNK).orderBy(PLACE)
        return Window.partitionBy(*self.keys, CHUNK).orderBy(*self.order, *([TIE] if self.chunked else []))

    def positioned(self) -> DataFrame:
        """Adds ``_ord`` (0-based ordinal inside the key) and ``_real``
        (the row belongs to this chunk, i.e. is not a halo copy)."""
        w = self.window
        if self.placed:  # a key in one partition counts from its first row
            return self.df.withColumn(ORD, F.coalesce(F.col(AT), (F.row_number().over(w) - 1).cast("long")))
        ordinal = (F.first(BUCKET_START).over(w.rowsBetween(Window.unboundedPreceding, 0))
                   + F.row_number().over(w) - F.lit(1))
        lo = F.col(CHUNK) * F.lit(self.chunk_rows)
        return (self.df.withColumn(ORD, ordinal)
                .withColumn(REAL, (F.col(ORD) >= lo) & (F.col(ORD) < lo + F.lit(self.chunk_rows))))


def _stats() -> list:
    out = [F.count(F.lit(1)).alias("_cnt")]
    for i in (1, 2):
        t = F.col(f"_t{i}")
        plain_t = F.when(~F.isnan(t), t)
        out += [F.count_if(t.isNull()).alias(f"_n{i}"), F.count_if(F.isnan(t)).alias(f"_q{i}"),
                F.min(plain_t).alias(f"_a{i}"), F.max(plain_t).alias(f"_b{i}")]
    return out


STAT_COLS = ["_cnt", *[f"_{s}{i}" for i in (1, 2) for s in "nqab"]]


def _step(fine: int) -> Column:
    """Place of a row in its cell, from the cell's statistics beside it: 0 for
    null, 1.. by equal steps, the last for NaN; 0 where nothing tells rows apart."""
    parts = F.ceil(F.col("_cnt") / F.lit(fine))

    def by(i: int) -> Column:
        t, width = F.col(f"_t{i}"), (F.col(f"_b{i}") - F.col(f"_a{i}")) / parts
        inner = F.when(width > 0, F.least(F.floor((t - F.col(f"_a{i}")) / width), parts - 1)).otherwise(F.lit(0).cast("long"))
        return F.when(t.isNull(), F.lit(0).cast("long")).when(F.isnan(t), parts + 1).otherwise(inner + 1)

    def varies(i: int) -> Column:
        kinds = ((F.col(f"_n{i}") > 0).cast("int") + (F.col(f"_q{i}") > 0).cast("int")
                 + (F.col("_cnt") > F.col(f"_n{i}") + F.col(f"_q{i}")).cast("int"))
        return F.coalesce(F.col(f"_b{i}") > F.col(f"_a{i}"), F.lit(False)) | (kinds > 1)

    return F.when(F.col("_cnt").isNull(), F.lit(0).cast("long")).when(varies(1), by(1)).when(varies(2), by(2)).otherwise(F.lit(0).cast("long"))


def _beside(x: DataFrame, table: DataFrame, keys: list, path: list, bring: list) -> DataFrame:
    """``x`` with the columns ``bring`` of its cell (null where the table has none); null keys match null keys."""
    on = [*keys, *path]
    right = table.select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(on)], *bring)
    cond = None
    for i, k in enumerate(on):
        one = F.col(k).eqNullSafe(F.col(f"__{i}"))
        cond = one if cond is None else cond & one
    return x.join(F.broadcast(right), cond, "left").drop(*[f"__{i}" for i in range(len(on))])


def sequence(df: DataFrame, keys: list, order: list, before: int = 0, after: int = 0,
             chunk_rows: int | None = None, fine_buckets: int | None = None) -> Sequenced:
    """Chunked plan (module docstring); keys of at most C rows are one chunk without halo."""
    spark = df.sparkSession
    keys, order = list(keys), list(order)
    least = int(chunk_rows or conf_chunk_rows(spark))
    if least < max(before, after, 1):
        raise ValueError("chunk_rows must be at least the halo length")
    numbers = [order_number(df, c) for c in order[:2]] + [F.lit(0.0)]
    folder = scratch_path(spark, f"placement-{uuid.uuid4().hex}")

    def kept(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{folder}/{name}")
        return spark.read.schema(table.schema).parquet(f"{folder}/{name}")

    base = df.withColumns({"_t1": numbers[0], "_t2": numbers[1]})
    narrow = base.select(*keys, "_t1", "_t2")
    cells = kept(narrow.groupBy(*keys).agg(*_stats()), "keys")
    total, largest = cells.agg(F.sum("_cnt"), F.max("_cnt")).first()
    C = least
    if (largest or 0) <= C:  # every key is one chunk: nothing to place
        return plain(df, keys, order)
    if total > MAX_CHUNKS * C:
        return ranged(df, keys, order, before, after, C, -(-total // C))
    fine = max(1, C // int(fine_buckets or conf_fine_buckets(spark)))

    tables = [cells.filter(F.col("_cnt") > C)]
    path: list = []

    def placed(x: DataFrame) -> DataFrame:
        for level, table in enumerate(tables):
            x = _beside(x, table, keys, [f"_f{i}" for i in range(level)], STAT_COLS)
            x = x.withColumn(f"_f{level}", _step(fine)).withColumn("_big", F.col("_cnt").isNotNull() if level == 0 else F.col("_big")).drop(*STAT_COLS)
        return x

    while True:
        path.append(f"_f{len(path)}")
        cells = kept(placed(narrow).filter("_big").groupBy(*keys, *path).agg(*_stats()), f"level{len(path)}")
        full = cells.filter((F.col("_cnt") > 2 * fine) & ((F.col("_b1") > F.col("_a1")) | (F.col("_b2") > F.col("_a2"))))
        if len(path) == LEVELS or not full.limit(1).collect():
            break
        tables.append(full)

    in_order = Window.partitionBy(*keys).orderBy(*path)
    start = F.coalesce(F.sum("_cnt").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    last_chunk = F.floor((F.sum("_cnt").over(Window.partitionBy(*keys)) - 1) / F.lit(C))
    spread = kept(cells.withColumn(BUCKET_START, start).select(
        *keys, *path, BUCKET_START,
        F.floor(F.greatest(F.col(BUCKET_START) - F.lit(after), F.lit(0)) / F.lit(C)).cast("long").alias("_lo"),
        F.least(F.floor((F.col(BUCKET_START) + F.col("_cnt") - 1 + F.lit(before)) / F.lit(C)), last_chunk).cast("long").alias("_hi")), "cells")

    tie = F.xxhash64(*df.columns)
    y = _beside(placed(base.withColumn(TIE, tie)), spread, keys, path, [BUCKET_START, "_lo", "_hi"])
    zero = F.lit(0).cast("long")
    chunks = F.when(F.col("_lo").isNull(), F.array(zero)).otherwise(F.sequence(F.col("_lo"), F.col("_hi")))
    y = (y.withColumn(CHUNK, F.explode(chunks)).withColumn(BUCKET_START, F.coalesce(F.col(BUCKET_START), zero))
         .drop("_t1", "_t2", "_big", "_lo", "_hi", *path))
    return Sequenced(y, keys, order, C)


def ranged(df: DataFrame, keys: list, order: list, before: int, after: int, chunk_rows: int, parts: int) -> Sequenced:
    """Placement of any number of chunks: range partitions of the whole order are the chunks.

    The rows are range-partitioned by (keys, order) into ``parts``, sorted and
    written once, each with its place.  A key in several partitions has a small
    row per partition: its start in the key and the neighbours that its last and
    first rows reach as halo.  There are at most two such rows per partition; they
    meet the rows by an ordinary join, which shuffles both sides evenly where they
    are too many to broadcast.  A row is then copied to the chunks that need it.
    Partition sizes are as even as the range sampling makes them.  Rows that agree
    in the whole order and in all columns stay in one partition.
    """
    spark = df.sparkSession
    folder = scratch_path(spark, f"ranged-{uuid.uuid4().hex}")

    def kept(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{folder}/{name}")
        return spark.read.schema(table.schema).parquet(f"{folder}/{name}")

    by = [*keys, *order, TIE]
    rows = kept(df.withColumn(TIE, F.xxhash64(*df.columns)).repartitionByRange(parts, *by).sortWithinPartitions(*by)
                .withColumn(PLACE, F.monotonically_increasing_id()), "rows")
    part = F.shiftright(PLACE, 33)  # the partition, by the definition of the place
    of_key = Window.partitionBy(*keys).orderBy("_part")
    each = rows.groupBy(*keys, part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min(PLACE).alias("_first"))
    some = (each.withColumns({CHUNK: (F.row_number().over(of_key) - 1).cast("long"), "_all": F.count(F.lit(1)).over(Window.partitionBy(*keys)),
                              "_start": F.coalesce(F.sum("_n").over(of_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")})
            .filter(F.col("_all") > 1))
    other = F.struct(CHUNK, "_start", (F.col("_start") + F.col("_n") - 1).alias("_end"))
    none = F.array().cast(f"array<struct<{CHUNK}:bigint,_start:bigint,_end:bigint>>")
    later = F.collect_list(other).over(of_key.rowsBetween(1, before)) if before else none
    earlier = F.collect_list(other).over(of_key.rowsBetween(-after, -1)) if after else none
    borders = some.withColumns({"_later": later, "_earlier": earlier}).select(
        *[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)], "_part", CHUNK, "_start", "_first",
        F.filter("_later", lambda q: q["_start"] - before < F.col("_start") + F.col("_n")).alias("_later"),
        F.filter("_earlier", lambda q: q["_end"] + after >= F.col("_start")).alias("_earlier"))
    borders = kept(borders, "borders")

    same = part == F.col("_part")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__{i}"))
    own = F.coalesce(CHUNK, F.lit(0).cast("long"))
    near = rows.join(borders, same, "left").withColumn(AT, F.col("_start") + F.col(PLACE) - F.col("_first"))
    reached = F.concat(F.array(own), F.transform(F.filter("_later", lambda q: F.col(AT) >= q["_start"] - before), lambda q: q[CHUNK]),
                       F.transform(F.filter("_earlier", lambda q: F.col(AT) <= q["_end"] + after), lambda q: q[CHUNK]))
    dealt = near.withColumns({"_to": F.explode(F.when(F.col("_start").isNull(), F.array(own)).otherwise(reached)), "_own": own})
    y = dealt.withColumns({CHUNK: F.col("_to"), REAL: F.col("_to") == F.col("_own")}).select(*df.columns, CHUNK, PLACE, AT, REAL)
    return Sequenced(y, keys, order, chunk_rows, placed=True)


def plain(df: DataFrame, keys: list, order: list) -> Sequenced:
    """One window partition per key: the form for bounded keys and for
    micro-batches, and what the chunked form is checked against."""
    y = df.withColumn(CHUNK, F.lit(0).cast("long")).withColumn(BUCKET_START, F.lit(0).cast("long"))
    return Sequenced(y, list(keys), list(order), 1 << 62, chunked=False)
