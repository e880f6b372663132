"""A table layout that lets one symbol's rows be read without the others.

Rows are stored in ``BUCKETS`` folders by a hash of the symbol, which keeps the
number of folders fixed however many symbols there are.  Before the write they
are range-partitioned by (bucket, symbol, time) and sorted so: a symbol with very
many rows is spread over files by time, a file holds few symbols and one stretch
of time, and its row-group statistics tell both.

A read names the bucket as a constant (a partition filter: other folders are
not listed) and pushes the symbol, and a time from which on, into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
BUCKET = "symbol_bucket"


def bucket_of(symbol: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(symbol), F.lit(buckets)).cast("int")


def write_store(df: DataFrame, path: str, symbol: str = "symbol", order=("ts", "event_id"), buckets: int = BUCKETS) -> None:
    keyed = df.withColumn(BUCKET, bucket_of(F.col(symbol), buckets))
    by = [BUCKET, symbol, *order]
    keyed.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def read_symbol(spark: SparkSession, path: str, symbol: str, since: Column | None = None, column: str = "symbol", time: str = "ts",
                buckets: int = BUCKETS) -> DataFrame:
    """All rows of a symbol, from a time on where one is given."""
    rows = spark.read.parquet(path)
    own = rows.filter((F.col(BUCKET) == bucket_of(F.lit(symbol), buckets)) & (F.col(column) == F.lit(symbol)))
    return (own if since is None else own.filter(F.col(time) >= since)).drop(BUCKET)
