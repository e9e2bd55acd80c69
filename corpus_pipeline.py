"""A corpus pipeline of five stages; every stage is written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitflow.llm import decontam, langid, mixture, neardup, tokenfile
from waitflow.llm.store import new_path


def _keep(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id is among ids (NULL matches NULL), columns unchanged."""
    own = ids.select(F.col("doc_id").alias("_id"))
    return docs.join(own, docs["doc_id"].eqNullSafe(own["_id"]), "left_semi")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no text, or no letter in it."""
    found = langid.identify(docs)
    return _keep(docs, found.filter(F.col("lang_pred") != langid.UNKNOWN))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of every group of near duplicates, once.

    Rows without a doc_id take no part and are all kept; of rows that share a doc_id, only those with equal texts are
    repeats.
    """
    found = neardup.near_duplicates(docs)
    alone = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    kept = _keep(docs, found.filter("kept")).withColumn("_alone", alone)
    return kept.dropDuplicates(["doc_id", "text", "_alone"]).drop("_alone")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, also with other numbers, names or units."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    dirty = decontam.hits(docs, benchmark).select(F.col("doc_id").alias("_id"))
    return docs.join(dirty, docs["doc_id"] == dirty["_id"], "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources up to the limit; every source keeps one whole epoch at least."""
    return mixture.mix(docs, mixture.mix_plan(docs))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns doc_id, start, n_tokens and ids_crc32, read back from them."""
    path = new_path(spark, "tokens")
    # The workers still hold what the stages before have learned.
    tokenfile.write_tokens(docs, path, memo_bytes=16 << 20)
    return tokenfile.checksums(spark, path)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_files", token_files),
]

# MinHash, unigram segmentation and the tokenizer are outside SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
