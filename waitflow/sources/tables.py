"""Readers for the Parquet input tables and generic table sinks."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitflow.sources import workspace

# Column types of the input tables; a fixed schema avoids footer inference over many files.
_LONG, _INT, _DOUBLE, _TEXT, _TIME = (
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.StringType(),
    T.TimestampNTZType(),
)
TABLES = {
    "lineitem": {
        "l_orderkey": _LONG,
        "l_partkey": _LONG,
        "l_suppkey": _LONG,
        "l_linenumber": _INT,
        "l_quantity": _DOUBLE,
        "l_extendedprice": _DOUBLE,
        "l_discount": _DOUBLE,
        "l_tax": _DOUBLE,
        "l_returnflag": _TEXT,
        "l_linestatus": _TEXT,
        "l_shipdate": _TIME,
    },
    "orders": {
        "o_orderkey": _LONG,
        "o_custkey": _LONG,
        "o_orderstatus": _TEXT,
        "o_totalprice": _DOUBLE,
        "o_orderdate": _TIME,
        "o_orderpriority": _TEXT,
    },
    "supplier": {"s_suppkey": _LONG, "s_name": _TEXT, "s_nationkey": _INT, "s_acctbal": _DOUBLE},
    "part": {
        "p_partkey": _LONG,
        "p_name": _TEXT,
        "p_brand": _TEXT,
        "p_type": _TEXT,
        "p_size": _INT,
        "p_retailprice": _DOUBLE,
    },
    "nation": {"n_nationkey": _INT, "n_name": _TEXT, "n_regionkey": _INT},
    "region": {"r_regionkey": _INT, "r_name": _TEXT},
    "pages": {"page_id": _LONG, "url": _TEXT, "html": _TEXT},
}


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    fields = [T.StructField(c, kind) for c, kind in TABLES[name].items()]
    return spark.read.schema(T.StructType(fields)).parquet(f"{directory}/{name}.parquet")


def write_table(
    df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite", within: list[str] | None = None
) -> None:
    """Replace (or append to) a Parquet table. Partition columns should have few values, such as the
    financial year; rows are gathered by them first so that no task writes a file per partition value,
    and AQE splits a partition value that is much larger than the rest. Columns given as `within` deal a
    partition value over more tasks, each of which sorts its rows to write them."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in [*partition_by, *(within or [])]])
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_observed(df: DataFrame, path: str, metrics: dict[str, Column], partition_by: list[str] | None = None) -> dict:
    """Replaces a table and returns aggregates over the rows as they were written, without a second pass.

    They are taken in the tasks that write, of which each counts once however often it is tried.
    """
    seen = Observation()
    gathered = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    writer = gathered.observe(seen, *[m.alias(n) for n, m in metrics.items()]).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return seen.get


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    write_table(df, path, partition_by, mode="append")


BATCH = "load_batch_id"
LINEAGE = ["data_source", "load_timestamp"]
DATA_SOURCE = "monthly sheets"


def with_lineage(df: DataFrame, batch_id: str | Column | None = None, data_source: str = DATA_SOURCE) -> DataFrame:
    """Load time and source of every row, and its batch where one is given."""
    tags = {"data_source": F.lit(data_source), "load_timestamp": F.current_timestamp()}
    if batch_id is not None:
        tags[BATCH] = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    return df.withColumns(tags)


def stage(
    df: DataFrame,
    path: str,
    batch_id: str | Column,
    data_source: str = DATA_SOURCE,
    partition_by: list[str] | None = None,
    within: list[str] | None = None,
) -> None:
    """Truncate-and-reload of a staging table, every row tagged with its batch, source and load time."""
    write_table(with_lineage(df, batch_id, data_source), path, partition_by, within=within)


def read_stored(spark: SparkSession, path: str, like: DataFrame | T.StructType) -> DataFrame:
    """A stored table by a known schema, so partition values keep their type and no footer is read for it."""
    schema = like if isinstance(like, T.StructType) else like.schema
    return spark.read.schema(schema).parquet(path)


def _partition_folder(path: str, values: dict[str, object]) -> str:
    for name, value in values.items():
        if value is None or not re.fullmatch(r"[A-Za-z0-9_.-]+", str(value)):
            raise ValueError(f"{name}={value!r}: partition values hold letters, digits, '_', '.' and '-', and are not NULL")
    return path + "".join(f"/{name}={value}" for name, value in values.items())


def drop_partition(spark: SparkSession, path: str, column: str, value: object) -> None:
    workspace.remove(spark, _partition_folder(path, {column: value}))


def stored_partitions(spark: SparkSession, path: str, schema: T.StructType, scope: Column) -> list[tuple]:
    """Values of the partition columns (the schema) that are stored inside a scope; no other column is read."""
    if not workspace.exists(spark, path):
        return []
    found = spark.read.schema(schema).parquet(path).filter(scope).distinct()
    return sorted(tuple(r) for r in found.collect())


def replace_scope(df: DataFrame, path: str, partition_by: list[str], scope: Column) -> list[tuple]:
    """Replaces all that is stored inside a scope by the rows of df, and returns the partitions that this touches.

    The scope is a condition on partition columns that all rows of df meet. Partitions that df has rows of are
    overwritten dynamically; those of the scope that it has no rows of any more are removed. Rows are counted by
    partition while they are written, so df is computed once. Every partition is replaced as a whole, and a run that
    breaks off can simply be repeated. Partitions have few values (months, batches): their list passes through the
    driver.
    """
    spark = df.sparkSession
    schema = T.StructType([df.schema[c] for c in partition_by])
    before = stored_partitions(spark, path, schema, scope)
    folders = [_partition_folder(path, dict(zip(partition_by, values))) for values in before]
    same = [reduce(and_, [F.col(c) == F.lit(v) for c, v in zip(partition_by, values)]) for values in before]
    seen = Observation()
    gathered = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if before:
        # Counted in the tasks that write, of which each counts once however often it is tried.
        gathered = gathered.observe(seen, *[F.count(F.when(c, 1)).alias(f"n{i}") for i, c in enumerate(same)])
    writer = gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)
    for i, old in enumerate(folders):
        if not seen.get[f"n{i}"]:
            workspace.remove(spark, old)
    return sorted({*before, *stored_partitions(spark, path, schema, scope)})


def create_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
