"""Stored tables: dimensions, flat facts, star facts and marts as Parquet, and views to query them by SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitflow.data import Data
from waitflow.functions import calendar
from waitflow.plans import facts, marts, stars
from waitflow.sources.pathways import with_specialty
from waitflow.sources.tables import create_view, write_table

DIMENSIONS = ["dim_date", "dim_trust", "dim_region", "dim_treatment_function", "dim_wait_band"]
FACTS = ["fact_rtt_incomplete", "fact_rtt_completed", "fact_rtt_new_periods"]
STARS = [
    "fact_rtt_incomplete_star",
    "fact_rtt_completed_star",
    "fact_rtt_new_periods_star",
    "fact_rtt_wait_band_star",
]
MARTS = ["v_monthly_summary", "v_national_monthly"]
PARTITION = "financial_year"


def _dated(df: DataFrame) -> DataFrame:
    return calendar.with_attributes(df, [PARTITION])


def build(spark: SparkSession, source: str, out: str) -> None:
    """Writes every table. Each layer reads the stored layer below it, so the pathway rows are read once per
    fact and the marts read facts only."""
    d = Data(spark, source)
    for name, df in d.dimensions().items():
        write_table(df, f"{out}/{name}")
    dims = {n: spark.read.parquet(f"{out}/{n}") for n in DIMENSIONS}

    sheets = {
        "fact_rtt_incomplete": (facts.incomplete(d.rows()), "Incomplete-Provider"),
        "fact_rtt_completed": (facts.completed(d.rows()), "Completed-Provider"),
        "fact_rtt_new_periods": (facts.new_periods(d.rows()), "New-Periods-Provider"),
    }
    for name, (df, kind) in sheets.items():
        flat = d.sourced(d.label(df), kind).drop("provider_id").withColumn("load_timestamp", F.current_timestamp())
        write_table(_dated(flat), f"{out}/{name}", [PARTITION])
    inc, done, new = (spark.read.parquet(f"{out}/{n}") for n in FACTS)

    for name, df in {
        "fact_rtt_incomplete_star": stars.star_incomplete(inc, dims),
        "fact_rtt_completed_star": stars.star_completed(done, dims),
        "fact_rtt_new_periods_star": stars.star_new_periods(new, dims),
        "fact_rtt_wait_band_star": stars.star_wait_band(inc, dims),
    }.items():
        write_table(_dated(df), f"{out}/{name}", [PARTITION])

    summary = marts.monthly_summary(facts.activity_from_facts(inc, done, new))
    trusts = dims["dim_trust"].join(dims["dim_region"], "region_key", "left").select(
        F.col("trust_code").alias("provider_org_code"),
        F.col("trust_name").alias("provider_org_name"),
        "region_code",
        "region_name",
    )
    labelled = with_specialty(summary.join(trusts, "provider_org_code", "left"))
    write_table(_dated(labelled), f"{out}/v_monthly_summary", [PARTITION])
    stored = spark.read.parquet(f"{out}/v_monthly_summary")
    write_table(marts.national_monthly(stored), f"{out}/v_national_monthly")


def open_views(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Every stored table as a temporary view of the same name."""
    names = [*DIMENSIONS, *FACTS, *STARS, *MARTS]
    return {n: create_view(spark.read.parquet(f"{out}/{n}"), n) for n in names}
