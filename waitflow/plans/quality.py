"""Data-quality reports. Each returns one small row set; none enforces anything."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.functions.numeric import sum_columns, zero
from waitflow.operators.keys import orphans
from waitflow.sources.tables import write_observed

STAR_KEYS = ["date_key", "trust_key", "region_key", "treatment_function_key", "wait_band_key"]


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, True))


def missing_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """NULL surrogate keys per star table; a key the table does not have stays NULL."""
    checks = []
    for name, df in tables.items():
        absent = F.lit(None).cast("long")
        found = [(_count(F.col(k).isNull()) if k in df.columns else absent).alias(f"missing_{k}") for k in STAR_KEYS]
        checks.append(df.agg(F.count(F.lit(1)).alias("total_rows"), *found).withColumn("table_name", F.lit(name)))
    columns = ["table_name", "total_rows", *[f"missing_{k}" for k in STAR_KEYS]]
    return stack(checks).select(*columns)


def write_checked(tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Writes star tables and reports their NULL keys from the same pass; columns as in missing_keys()."""
    found = []
    for name, df in tables.items():
        metrics = {f"missing_{k}": _count(F.col(k).isNull()) for k in STAR_KEYS if k in df.columns}
        found.append((name, write_observed(df, f"{folder}/{name}", {"total_rows": F.count(F.lit(1)), **metrics})))
    columns = ["total_rows", *[f"missing_{k}" for k in STAR_KEYS]]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(
        [(name, *[counts.get(c) for c in columns]) for name, counts in found],
        ", ".join(["table_name string", *[f"{c} long" for c in columns]]),
    )


def orphan_report(links: list[tuple[str, DataFrame, DataFrame, str, str]]) -> DataFrame:
    """Rows and distinct values of each foreign key that meet no dimension row."""
    checks = []
    for name, facts, dimension, foreign, primary in links:
        found = orphans(facts, dimension, foreign, primary)
        checks.append(
            found.agg(
                F.count(F.lit(1)).alias("n_orphan_keys"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_orphan_rows")
            ).select(F.lit(name).alias("foreign_key"), "n_orphan_keys", "n_orphan_rows")
        )
    return stack(checks)


def negatives(df: DataFrame, measures: list[str]) -> DataFrame:
    """Negative values per measure, all measures in one pass."""
    counts = df.agg(*[_count(F.col(m) < 0).alias(m) for m in measures])
    return counts.unpivot([], measures, "measure", "n_negative")


def duplicate_codes(dimensions: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Codes carried by more than one row of a dimension."""
    checks = []
    for name, (df, code) in dimensions.items():
        per_code = df.groupBy(F.col(code).alias("code")).agg(F.count(F.lit(1)).alias("n"))
        checks.append(
            per_code.agg(F.count(F.lit(1)).alias("n_codes"), _count(F.col("n") > 1).alias("n_duplicated")).select(
                F.lit(name).alias("dimension"), "n_codes", "n_duplicated"
            )
        )
    return stack(checks)


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per required column, all columns in one pass."""
    counts = df.agg(*[_count(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "n_null")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n, df in tables.items()
    ]
    return stack(counts)


def coverage(df: DataFrame) -> DataFrame:
    """First and last month and the number of months, grouped to months before counting."""
    months = df.groupBy("period_date").agg(F.lit(1).alias("one"))
    return months.agg(
        F.min("period_date").alias("earliest_period"),
        F.max("period_date").alias("latest_period"),
        F.count("period_date").alias("months_loaded"),
    )


def expected_counts(counts: DataFrame, expected: dict[str, int] = S.EXPECTED_COUNTS) -> DataFrame:
    """Actual against expected dimension sizes."""
    pairs = [F.when(F.col("table_name") == n, F.lit(v)) for n, v in expected.items()]
    wanted = F.coalesce(*pairs).cast("long")
    return counts.select(
        "table_name", "row_count", wanted.alias("expected_count"), (F.col("row_count") - wanted).alias("difference")
    )


def band_totals(df: DataFrame) -> DataFrame:
    """Published totals against the sum of the twelve bands, per month."""
    gap = zero("total_waiting") - sum_columns(S.BAND_COLUMNS)
    return (
        df.withColumn("gap", gap)
        .groupBy("period_date")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            _count(F.col("gap") != 0).alias("n_different"),
            F.sum("gap").cast("long").alias("total_gap"),
        )
    )

