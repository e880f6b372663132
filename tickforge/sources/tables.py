"""Readers for the parquet tables and the canonical tick adapter.

A *tick table* has columns ``symbol STRING, price DOUBLE, ts TIMESTAMP,
event_id BIGINT, date DATE``; series are keyed by ``symbol`` and ordered by
``(ts, event_id)``.  All readers select only the columns they need so that
Catalyst prunes the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TICK_KEY = ["symbol"]
TICK_ORDER = ["ts", "event_id"]

# Fixed values of the tick adapter: the market suffix chosen by user_id % 3.
MARKET_SUFFIXES = ("Index", "Comdty", "Spot")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def symbol_expr(event_type: Column, user_id: Column) -> Column:
    m = F.pmod(user_id, F.lit(3))
    suffix = (F.when(m == 0, F.lit(MARKET_SUFFIXES[0]))
              .when(m == 1, F.lit(MARKET_SUFFIXES[1]))
              .otherwise(F.lit(MARKET_SUFFIXES[2])))
    return F.concat(F.upper(event_type), F.lit(" "), suffix)


def ticks_from_events(events: DataFrame) -> DataFrame:
    """events(event_id, ts, user_id, event_type, value) -> tick table."""
    return events.select(
        symbol_expr(F.col("event_type"), F.col("user_id")).alias("symbol"),
        F.col("value").alias("price"),
        F.col("ts"),
        F.col("event_id"),
        F.col("ts").cast("date").alias("date"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical tick stream of the test data (events table)."""
    return ticks_from_events(read_table(spark, sf_dir, "events"))


def clean_ticks(df: DataFrame) -> DataFrame:
    """Not-null filter on price and symbol (kept ahead of every series op)."""
    return df.filter(F.col("price").isNotNull() & F.col("symbol").isNotNull())


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second domain: order totals per customer as a price series.

    key = o_custkey, order = (o_orderdate, o_orderkey), value = o_totalprice.
    """
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderdate").alias("odate"),
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_totalprice").alias("price"),
    )
