"""Registered queries of this subpackage, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waitflow.llm import decontam, divergence, fim, forest, langid, mixlm, mixture, neardup, pii, shards, tokenfile, toxicity, urlrules
from waitflow.llm.store import new_path


def _read(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op1_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.digest(_read(spark, d, "documents"))


def op2_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, d, "documents"))


def op3_context_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixlm.score(_read(spark, d, "documents"))


def op4_language(spark: SparkSession, d: str) -> DataFrame:
    return langid.identify(_read(spark, d, "documents"))


def op5_token_files(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "tokens")
    tokenfile.write_tokens(_read(spark, d, "documents"), path)
    return tokenfile.checksums(spark, path)


def op6_byte_shards(spark: SparkSession, d: str) -> DataFrame:
    return shards.cut_by_bytes(_read(spark, d, "documents"))


def op7_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return decontam.decontaminate(_read(spark, d, "documents"), _read(spark, d, "benchmark"))


def op8_mix_sources(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix_plan(_read(spark, d, "documents"))


def op9_nearest(spark: SparkSession, d: str) -> DataFrame:
    return forest.search(_read(spark, d, "embeddings"))


def op10_url_rules(spark: SparkSession, d: str) -> DataFrame:
    return urlrules.judge(_read(spark, d, "pages"))


def op11_fill_in_middle(spark: SparkSession, d: str) -> DataFrame:
    return fim.digest(_read(spark, d, "documents"))


def op12_source_divergence(spark: SparkSession, d: str) -> DataFrame:
    return divergence.audit(_read(spark, d, "documents"))


def op13_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.score(_read(spark, d, "documents"), _read(spark, d, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_near_duplicates,
        op3_context_mixing,
        op4_language,
        op5_token_files,
        op6_byte_shards,
        op7_decontaminate,
        op8_mix_sources,
        op9_nearest,
        op10_url_rules,
        op11_fill_in_middle,
        op12_source_divergence,
        op13_toxicity,
    )
}

ORACLES: dict[str, str] = {
    "op8_mix_sources": mixture.mix_plan_sql(),
    "op10_url_rules": urlrules.judge_sql(),
    "op11_fill_in_middle": fim.digest_sql(),
    "op12_source_divergence": divergence.audit_sql(),
}
