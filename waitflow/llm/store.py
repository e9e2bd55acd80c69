"""Tables written to the folder that all machines share, to cut lineage or to read a result twice."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only a local master without that setting gets a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="waitflow-llm-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return _own[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, computed once and written; the table survives the loss of any executor."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
