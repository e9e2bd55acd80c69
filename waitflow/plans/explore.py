"""Slicing, drill-down, matrix and report frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waitflow.functions import calendar
from waitflow.functions.numeric import percent
from waitflow.plans.marts import sums


def slice_by(
    df: DataFrame,
    financial_years: list[str] | None = None,
    region: str | None = None,
    group: str | None = None,
    covid: bool | None = None,
    trust_like: str | None = None,
) -> DataFrame:
    """All given slicers at once; a slicer left out keeps everything."""
    month = F.col("period_date")
    if financial_years is not None:
        df = df.filter(calendar.financial_year(month).isin(financial_years))
    if covid is not None:
        inside = calendar.is_covid(month)
        df = df.filter(inside if covid else ~inside)
    if region is not None:
        df = df.filter(F.col("region_name") == region)
    if group is not None:
        df = df.filter(F.col("specialty_group") == group)
    if trust_like is not None:
        df = df.filter(F.lower("provider_org_name").contains(trust_like.lower()))
    return df


def month_bounds(financial_years: list[str]) -> tuple[str, str]:
    """First and last month of a choice of financial years ('2021/22'); years between them may be left out."""
    starts = sorted(int(y[:4]) for y in financial_years)
    return f"{starts[0]}-04-01", f"{starts[-1] + 1}-03-01"


def region_year_matrix(summary: DataFrame, years: list[str]) -> DataFrame:
    """Region rows, one column per year and rate. The years are the columns of the result, so they are given."""
    grouped = (
        calendar.with_attributes(summary, ["financial_year"]).groupBy("region_name", "financial_year").agg(*sums())
    )
    rated = grouped.select(
        "region_name",
        "financial_year",
        percent(F.col("waiting_over_18wks"), F.col("total_waiting")).alias("breach"),
        percent(F.col("total_completed"), F.col("new_rtt_periods")).alias("throughput"),
        percent(F.col("waiting_over_52wks"), F.col("total_waiting")).alias("long"),
    )
    cells = rated.groupBy("region_name").pivot("financial_year", years).agg(
        F.max("breach").alias("breach"), F.max("throughput").alias("throughput"), F.max("long").alias("long")
    )
    renamed = {f"{y}_{r}": f"{r}_{y.replace('/', '_')}" for y in years for r in ("breach", "throughput", "long")}
    return cells.withColumnsRenamed(renamed)


def drilldown(national: DataFrame) -> DataFrame:
    """Year, quarter and month totals with subtotals; months are summed first, so ROLLUP expands few rows."""
    framed = calendar.with_attributes(national, ["financial_year", "financial_quarter"])
    return framed.rollup("financial_year", "financial_quarter", "period_date").agg(
        F.grouping_id().cast("int").alias("level"), *sums()
    )


def peak_month(national: DataFrame) -> DataFrame:
    """Largest month by long waiters; the earliest month wins a tie."""
    return (
        national.select(F.col("period_date").alias("peak_month"), F.col("waiting_over_52wks").alias("peak_value"))
        .orderBy(F.desc("peak_value"), "peak_month")
        .limit(1)
    )


def long_waiters_by_specialty(summary: DataFrame) -> DataFrame:
    return summary.groupBy("period_date", "treatment_function_name").agg(
        F.sum("waiting_over_52wks").alias("waiting_over_52wks")
    )


def waterfall(summary: DataFrame) -> DataFrame:
    """Month-on-month change per specialty split into additions and removals."""
    w = Window.partitionBy("treatment_function_name").orderBy("period_date")
    moved = F.col("waiting_over_52wks") - F.lag("waiting_over_52wks").over(w)
    return long_waiters_by_specialty(summary).withColumn("change", moved).select(
        "period_date",
        "treatment_function_name",
        "waiting_over_52wks",
        F.when(F.col("change").isNotNull(), F.greatest("change", F.lit(0))).alias("added"),
        F.when(F.col("change").isNotNull(), F.least("change", F.lit(0))).alias("cleared"),
    )


def profile(cells: DataFrame) -> DataFrame:
    """Rows, months, providers and period range per source of (source, period_date, provider_id) rows.

    Rows are grouped to month and provider first; each distinct count then works on that grain alone.
    """
    return profile_counted(cells.groupBy("source", "period_date", "provider_id").agg(F.count(F.lit(1)).alias("n")))


def profile_counted(per_key: DataFrame) -> DataFrame:
    """The same from n rows by source, period_date and provider_id."""
    return per_key.groupBy("source").agg(
        F.sum("n").alias("n_rows"),
        F.count_distinct("period_date").alias("n_months"),
        F.count_distinct("provider_id").alias("n_trusts"),
        F.min("period_date").alias("first_month"),
        F.max("period_date").alias("last_month"),
    )


def financial_years(summary: DataFrame) -> list[str]:
    """Every financial year from the first month of the frame to the last, at most one per year of data."""
    start = F.year(F.add_months("period_date", -3))
    first, last = summary.agg(F.min(start), F.max(start)).first()
    return [] if first is None else [f"{y}/{(y + 1) % 100:02d}" for y in range(first, last + 1)]
