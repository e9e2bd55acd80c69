"""Tables stored in buckets of their join key, so that joins on it move no rows."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitflow.sources import workspace

BUCKET_ROWS = 4_000_000  # rows of a bucket, some hundred MB of narrow rows


def bucket_count(rows: int, least: int = 8) -> int:
    """A power of two, so that tables of different sizes still join bucket by bucket."""
    count = least
    while count * BUCKET_ROWS < rows:
        count *= 2
    return count


def store(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Writes a table of the session's catalog in buckets of the key, sorted by it, and returns it.

    Rows are dealt by bucket before they are written, so a bucket is one file; a key's rows share a bucket.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid4().hex}"
    dealt = df.repartition(buckets, F.col(key))
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)
    workspace.keep_until_exit(spark, f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}")
    return spark.table(table)


def store_orders(lines: DataFrame, orders: DataFrame, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Order lines and orders in equally many buckets of the order key."""
    buckets = buckets or bucket_count(lines.count())
    return store(lines, "lines", "l_orderkey", buckets), store(orders, "orders", "o_orderkey", buckets)
