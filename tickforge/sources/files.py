"""File sources and sinks: wide/long CSV, JSON tick envelope and the Kafka source/sink option maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import session_open_text

# Wire schema of a tick message.
TICK_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])

LONG_SCHEMA = "date DATE, symbol STRING, price DOUBLE"


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header-driven wide table, every column read as string."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def write_long_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_long_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(LONG_SCHEMA).csv(path)


def tick_envelope(df: DataFrame, date: str = "date", symbol: str = "symbol", price: str = "price") -> DataFrame:
    """Tick message: JSON {date, symbol, price, timestamp='<date> 09:30:00'} in ``value``."""
    d = F.date_format(F.col(date), "yyyy-MM-dd")
    return df.select(F.to_json(F.struct(
        d.alias("date"), F.col(symbol).alias("symbol"), F.col(price).alias("price"),
        session_open_text(d).alias("timestamp"))).alias("value"))


def parse_envelope(df: DataFrame, schema: T.StructType = TICK_SCHEMA, value: str = "value") -> DataFrame:
    """Decode the JSON ``value`` (string or binary); malformed -> all-null fields."""
    return df.select(F.from_json(F.col(value).cast("string"), schema).alias("data")).select("data.*")


def to_wire(df: DataFrame) -> DataFrame:
    """Any record -> one JSON ``value`` column (nulls are omitted by to_json)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def kafka_source_options(bootstrap: str, topic: str, starting: str = "latest") -> dict:
    return {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting, "failOnDataLoss": "false"}


def kafka_sink_options(bootstrap: str, topic: str, checkpoint: str) -> dict:
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, "checkpointLocation": checkpoint}


def read_kafka_stream(spark: SparkSession, bootstrap: str, topic: str, starting: str = "latest") -> DataFrame:
    """Structured Streaming Kafka source (needs the spark-sql-kafka package)."""
    r = spark.readStream.format("kafka")
    for k, v in kafka_source_options(bootstrap, topic, starting).items():
        r = r.option(k, v)
    return r.load()
