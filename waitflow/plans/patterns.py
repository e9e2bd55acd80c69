"""Star join patterns: facts at month grain rolled up, then labelled from the dimensions.

Each pattern sums the fact by its keys first and joins the labels afterwards, so the rows that meet the
dimensions are the rolled-up ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.functions import calendar
from waitflow.functions.numeric import ratio, steady
from waitflow.plans.facts import banded
from waitflow.plans.kpis import change

Labels = Callable[[DataFrame], DataFrame]
KEY = ["financial_year", "provider_id", "treatment_function_code"]


def _by_year(df: DataFrame) -> DataFrame:
    return calendar.with_attributes(df, ["financial_year"])


def waiting_by_trust(incomplete: DataFrame, label: Labels) -> DataFrame:
    """Financial year x region x provider x specialty."""
    grouped = _by_year(incomplete).groupBy(*KEY).agg(
        F.sum("total_waiting").alias("total_waiting"),
        F.sum(S.LONG_COLUMN).alias("long_waiters_52_plus"),
        steady(F.avg("percentile_92_wait_weeks"), 5).alias("avg_p92_wait"),
    )
    return label(grouped).select(
        "financial_year",
        "region_name",
        "provider_org_name",
        "treatment_function_name",
        "total_waiting",
        "long_waiters_52_plus",
        "avg_p92_wait",
    )


def completed_by_pathway(completed: DataFrame, label: Labels) -> DataFrame:
    """Financial year x region x specialty x pathway; the mean is over the fact rows of the group."""
    grouped = _by_year(completed).groupBy(*KEY, "pathway_type").agg(
        F.sum("total_completed").alias("total_completed"),
        F.sum("median_wait_weeks").alias("waits"),
        F.count("median_wait_weeks").alias("rows"),
    )
    return (
        label(grouped)
        .groupBy("financial_year", "region_name", "treatment_function_name", "pathway_type")
        .agg(
            F.sum("total_completed").alias("total_completed"),
            steady(F.sum("waits") / F.sum("rows")).alias("avg_median_wait"),
        )
    )


def demand(new_periods: DataFrame, label: Labels) -> DataFrame:
    """Financial year x region x specialty."""
    grouped = new_periods.groupBy(*KEY).agg(F.sum("new_rtt_periods").alias("new_rtt_periods"))
    return (
        label(grouped)
        .groupBy("financial_year", "region_name", "treatment_function_name")
        .agg(F.sum("new_rtt_periods").alias("new_rtt_periods"))
    )


def band_distribution(bands: DataFrame, label: Labels, dim_band: DataFrame) -> DataFrame:
    """Financial year x region x specialty x band, from band columns summed per key."""
    keys = ["financial_year", "region_name", "treatment_function_name"]
    sums = [F.sum(c).alias(c) for c in S.BAND_COLUMNS]
    grouped = label(bands).groupBy(*keys).agg(*sums)
    flags = F.broadcast(dim_band.select("band_label", "is_breach", "is_long_waiter"))
    return banded(grouped, keys).join(flags, "band_label").select(
        *keys, "band_label", "is_breach", "is_long_waiter", "patients_waiting"
    )


def suppression_signal(totals: DataFrame) -> DataFrame:
    """Months with anyone waiting: treatments per referral and the change of the list."""
    framed = calendar.with_attributes(
        totals.filter(F.col("total_waiting").isNotNull()), ["financial_year", "month_name", "is_covid_period"]
    )
    return framed.select(
        "period_date",
        "financial_year",
        "month_name",
        "is_covid_period",
        "total_waiting",
        "total_completed",
        "new_rtt_periods",
        ratio(F.col("total_completed"), F.col("new_rtt_periods")).alias("treatment_per_referral_ratio"),
        change("total_waiting").alias("mom_list_change"),
    )


def drilldown_validation(incomplete: DataFrame, label: Labels, rows: int = 50) -> DataFrame:
    """First rows of month x region x provider x specialty, in calendar order."""
    order = ["period_date", "region_name", "provider_org_name", "treatment_function_name"]
    framed = calendar.with_attributes(label(incomplete), ["financial_year", "month_name"])
    grouped = framed.groupBy(*order, "financial_year", "month_name").agg(
        F.sum("total_waiting").alias("total_waiting")
    )
    return grouped.orderBy(*order).limit(rows)


def breach_analysis(distribution: DataFrame, rows: int = 50) -> DataFrame:
    """Largest breach groups, by financial year and size; the labels settle ties."""
    order = [
        F.asc("financial_year"),
        F.desc("patients_waiting"),
        F.asc("region_name"),
        F.asc("treatment_function_name"),
        F.asc("band_label"),
    ]
    return distribution.filter("is_breach = 1").orderBy(*order).limit(rows)


def band_breach_totals(distribution: DataFrame) -> DataFrame:
    return distribution.groupBy("band_label", "is_breach").agg(F.sum("patients_waiting").alias("patients_waiting"))
