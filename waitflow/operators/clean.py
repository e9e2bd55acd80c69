"""Cleaning of sheet rows: renames, code whitelist, coercion and the collapse to twelve bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.functions.numeric import double_sql, to_count, to_double
from waitflow.functions.text import is_code, parse_period
from waitflow.operators.keys import keep_first


def rename_core(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(S.RENAMES)


def clean_rows(df: DataFrame) -> DataFrame:
    """Keeps rows with a real provider code; blank, total and footnote rows go."""
    return df.dropna(subset=["provider_org_code"]).filter(is_code(F.col("provider_org_code")))


def _named(name: str) -> Column:
    return F.col(f"`{name}`")


def find_column(columns: list[str], part: str) -> str | None:
    """First column whose name contains the part, ignoring case."""
    return next((c for c in columns if part.lower() in c.lower()), None)


def _number(df: DataFrame, name: str) -> Column:
    return to_double(_named(name)) if name in df.columns else F.lit(None).cast("double")


def _count(df: DataFrame, name: str | None) -> Column:
    return to_count(_named(name)) if name in df.columns else F.lit(0).cast("long")


def band_columns(columns: list[str]) -> list[Column]:
    """Twelve bands from the weekly columns; a missing column and an unreadable cell both count 0."""
    weekly = [*S.WEEK_COLUMNS, S.OPEN_WEEK_COLUMN]
    bands = []
    for name, _, first, last, *_ in S.BANDS:
        # Cells of one band are added as doubles and cut to a whole number once. A band of blank cells, as nearly all
        # are, is known by its joined text, which is compiled; lambdas are not, and 53 casts in a row are too long to be.
        cells = ", ".join(f"CAST(`{c}` AS STRING)" for c in weekly[first : last + 1] if c in columns)
        total = f"aggregate(filter(array({cells}), c -> c <> ''), 0D, (sum, c) -> sum + coalesce({double_sql('c')}, 0D))"
        total = f"CASE WHEN concat_ws('', {cells}) = '' THEN 0D ELSE {total} END" if cells else "0"
        bands.append(F.expr(f"try_cast({total} AS BIGINT) AS {name}"))
    return bands


def _tail(df: DataFrame) -> list[str]:
    return [c for c in ("period_date", "source_file") if c in df.columns]


def silver_incomplete(sheet: DataFrame) -> DataFrame:
    df = clean_rows(rename_core(sheet))
    return df.select(
        *S.BASE_COLUMNS,
        *band_columns(df.columns),
        _count(df, "total_waiting").alias("total_waiting"),
        _number(df, "median_wait_weeks").alias("median_wait_weeks"),
        _number(df, "percentile_92_wait_weeks").alias("percentile_92_wait_weeks"),
        *_tail(df),
    )


def silver_completed(sheet: DataFrame, pathway_type: str) -> DataFrame:
    df = clean_rows(rename_core(sheet))
    return df.select(
        *S.BASE_COLUMNS,
        _count(df, find_column(df.columns, S.COMPLETED_TOTAL_HINT)).alias("total_completed"),
        _number(df, "median_wait_weeks").alias("median_wait_weeks"),
        _number(df, "percentile_92_wait_weeks").alias("percentile_92_wait_weeks"),
        F.lit(pathway_type).alias("pathway_type"),
        *_tail(df),
    )


def silver_new_periods(sheet: DataFrame) -> DataFrame:
    df = clean_rows(rename_core(sheet))
    return df.select(*S.BASE_COLUMNS, _count(df, "new_rtt_periods").alias("new_rtt_periods"), *_tail(df))


def combine(df: DataFrame, row_order: list[str]) -> DataFrame:
    """One row per key over all files: the first file, and the first row in it, wins."""
    key = S.CELL_KEY + (["pathway_type"] if "pathway_type" in df.columns else [])
    return keep_first(df, key, row_order)


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a readable period, typed, and the rows of files without one."""
    parsed = df.withColumn("_period", parse_period(F.col("period_date")))
    good = parsed.filter("_period IS NOT NULL").withColumn("period_date", F.col("_period")).drop("_period")
    return good, parsed.filter("_period IS NULL").drop("_period")
