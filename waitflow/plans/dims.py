"""The five dimensions, from seeds and from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.functions import calendar
from waitflow.operators.keys import keep_first, with_surrogate_key

# Columns of the date dimension.
DATE_COLUMNS = [
    "date_key",
    "full_date",
    "year",
    "quarter",
    "month",
    "month_name",
    "financial_year",
    "financial_quarter",
    "is_covid_period",
]


def dim_date(months: DataFrame, column: str = "full_date") -> DataFrame:
    """Calendar attributes of each month in a frame of distinct months."""
    found = calendar.attributes(F.col(column))
    return months.select(*[found[c].alias(c) for c in DATE_COLUMNS])


def standard_dim_date(
    spark: SparkSession, start: str = S.CALENDAR_START, end: str = S.CALENDAR_END
) -> DataFrame:
    return dim_date(calendar.months(spark, start, end))


def calendar_with(df: DataFrame, column: str = "period_date", start: str = S.CALENDAR_START, end: str = S.CALENDAR_END) -> DataFrame:
    """Every month of the standard calendar, and on to the first and last month of a frame."""
    ends = df.agg(F.min(column).alias("a"), F.max(column).alias("b"))
    first, last = F.least(F.lit(start).cast("date"), F.col("a")), F.greatest(F.lit(end).cast("date"), F.col("b"))
    return ends.select(F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("full_date"))


def months_between_extremes(df: DataFrame, column: str = "period_date") -> DataFrame:
    """Every month from the first to the last one present, gaps included."""
    ends = df.agg(F.min(column).alias("a"), F.max(column).alias("b"))
    return ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("full_date"))


def _rows(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """Seed rows as literals of the plan: no Python worker and a known size."""
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    structs = [
        F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, fields)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def dim_region(spark: SparkSession) -> DataFrame:
    rows = [(i, *r) for i, r in enumerate(S.REGIONS, 1)]
    return _rows(
        spark, "region_key int, region_code string, region_name string, nhs_region_abbrev string", rows
    )


def dim_wait_band(spark: SparkSession) -> DataFrame:
    rows = [(i, b[1], *b[4:]) for i, b in enumerate(S.BANDS, 1)]
    return _rows(
        spark,
        "wait_band_key int, band_label string, lower_weeks int, upper_weeks int, "
        "is_breach int, is_long_waiter int",
        rows,
    )


def seed_treatment_functions(spark: SparkSession) -> DataFrame:
    rows = [(i, *r) for i, r in enumerate(S.TREATMENT_FUNCTIONS, 1)]
    return _rows(
        spark,
        "treatment_function_key int, treatment_function_code string, "
        "treatment_function_name string, specialty_group string",
        rows,
    )


def region_dimension(regions: DataFrame) -> DataFrame:
    """Region keys for the region codes found in the data."""
    distinct = regions.dropna(subset=["region_code"]).groupBy("region_code").agg(
        F.min("region_name").alias("region_name")
    )
    return with_surrogate_key(distinct, "region_code", "region_key", bounded=True).select(
        "region_key", "region_code", "region_name"
    )


def dim_trust(providers: DataFrame, regions: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One row per provider code, first seen wins; the region resolves by code and defaults to 1.

    `order` names the columns that say which row was seen first; without it the smallest name is kept.
    """
    clean = providers.dropna(subset=["provider_org_code"]).withColumns(
        {c: F.trim(c) for c in ("provider_org_code", "provider_org_name", "region_code")}
    )
    first = keep_first(clean, ["provider_org_code"], order or ["provider_org_name", "region_code"])
    keyed = first.join(regions.select("region_code", "region_key"), "region_code", "left").select(
        F.col("provider_org_code").alias("trust_code"),
        F.col("provider_org_name").alias("trust_name"),
        F.coalesce("region_key", F.lit(S.DEFAULT_REGION_KEY)).alias("region_key"),
        F.lit(1).alias("is_active"),
    )
    return with_surrogate_key(keyed, "trust_code", "trust_key").select(
        "trust_key", "trust_code", "trust_name", "region_key", "is_active"
    )


def dim_treatment_function(specialties: DataFrame) -> DataFrame:
    """One row per specialty code, numbered in code order."""
    distinct = (
        specialties.dropna(subset=["treatment_function_code"])
        .groupBy(F.trim("treatment_function_code").alias("treatment_function_code"))
        .agg(
            F.min("treatment_function_name").alias("treatment_function_name"),
            F.min("specialty_group").alias("specialty_group"),
        )
    )
    return with_surrogate_key(distinct, "treatment_function_code", "treatment_function_key", bounded=True).select(
        "treatment_function_key", "treatment_function_code", "treatment_function_name", "specialty_group"
    )
