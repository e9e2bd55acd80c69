"""Dashboard measures. Each takes the monthly summary and the columns of the filter context.

Calendar shifts use RANGE frames over a running month number: a missing month gives NULL, where a row-based
LAG would take the month before the gap. `blank_as_zero` gives the dashboard rule that a missing value
counts as 0 in a subtraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.functions import calendar
from waitflow.functions.numeric import percent, ratio, steady
from waitflow.plans.marts import MEASURES, sums


def totals(summary: DataFrame, by: list[str]) -> DataFrame:
    return summary.groupBy(*by).agg(*sums(MEASURES))


def _months(summary: DataFrame, by: list[str]) -> DataFrame:
    """Month grain inside the context, with the running month number."""
    return totals(summary, ["period_date", *by]).withColumn("_m", calendar.month_index(F.col("period_date")))


def _calendar(by: list[str]) -> WindowSpec:
    return Window.partitionBy(*by).orderBy("_m")


def _shifted(c: str, months: int, by: list[str]) -> Column:
    return F.sum(c).over(_calendar(by).rangeBetween(-months, -months))


def core(summary: DataFrame, by: list[str]) -> DataFrame:
    return totals(summary, by).select(
        *by,
        "total_waiting",
        F.col("waiting_over_18wks").alias("waiting_over_18_weeks"),
        F.col("waiting_over_52wks").alias("long_waiters_52_plus"),
        F.col("total_completed").alias("total_treated"),
        F.col("new_rtt_periods").alias("new_referrals"),
    )


def breach_rate() -> Column:
    return percent(F.col("waiting_over_18wks"), F.col("total_waiting"), 0)


def rates(summary: DataFrame, by: list[str]) -> DataFrame:
    long_rate = percent(F.col("waiting_over_52wks"), F.col("total_waiting"), 0)
    return totals(summary, by).select(
        *by, breach_rate().alias("breach_rate_pct"), long_rate.alias("long_waiter_rate_pct")
    )


def change_from(
    summary: DataFrame, by: list[str], c: str, months: int, name: str, blank_as_zero: bool = False
) -> DataFrame:
    before = _shifted(c, months, by)
    if blank_as_zero:
        before = F.coalesce(before, F.lit(0))
    return _months(summary, by).select("period_date", *by, c, (F.col(c) - before).alias(name))


def waiting_mom(summary: DataFrame, by: list[str], blank_as_zero: bool = False) -> DataFrame:
    return change_from(summary, by, "total_waiting", 1, "waiting_mom_change", blank_as_zero)


def waiting_yoy(summary: DataFrame, by: list[str], blank_as_zero: bool = False) -> DataFrame:
    before = _shifted("total_waiting", 12, by)
    base = F.coalesce(before, F.lit(0)) if blank_as_zero else before
    moved = F.col("total_waiting") - base
    return _months(summary, by).select(
        "period_date",
        *by,
        "total_waiting",
        moved.alias("waiting_yoy_change"),
        percent(moved, before).alias("waiting_yoy_pct"),
    )


def ratio_flow(summary: DataFrame, by: list[str]) -> DataFrame:
    starts, done = F.col("new_rtt_periods"), F.col("total_completed")
    return totals(summary, by).select(
        *by,
        ratio(starts, done).alias("referral_to_treatment_ratio"),
        (starts - done).alias("net_flow"),
        (starts - done).alias("referral_suppression_signal"),
    )


def index_jan2020(summary: DataFrame, by: list[str]) -> DataFrame:
    """Each context against its own index month."""
    at_index = F.col("period_date") == F.lit(S.INDEX_MONTH).cast("date")

    def indexed(c: str) -> Column:
        return percent(F.col(c), F.max(F.when(at_index, F.col(c))).over(Window.partitionBy(*by)))

    return totals(summary, ["period_date", *by]).select(
        "period_date",
        *by,
        indexed("new_rtt_periods").alias("referral_index_vs_jan2020"),
        indexed("total_completed").alias("treatment_index_vs_jan2020"),
    )


def throughput(summary: DataFrame, by: list[str]) -> DataFrame:
    rate = percent(F.col("total_completed"), F.col("new_rtt_periods"), 0)
    return totals(summary, by).select(*by, rate.alias("throughput_rate_pct"))


def long_waiter_mom(summary: DataFrame, by: list[str], blank_as_zero: bool = False) -> DataFrame:
    return change_from(summary, by, "waiting_over_52wks", 1, "long_waiter_mom_change", blank_as_zero)


def long_waiter_12m(summary: DataFrame, by: list[str]) -> DataFrame:
    before = _shifted("waiting_over_52wks", 12, by)
    return _months(summary, by).select(
        "period_date",
        *by,
        percent(F.col("waiting_over_52wks") - before, before).alias("long_waiter_12m_reduction_pct"),
    )


def admitted_share(summary: DataFrame, by: list[str]) -> DataFrame:
    share = percent(F.col("completed_admitted"), F.col("total_completed"), 0)
    return totals(summary, by).select(*by, share.alias("admitted_share_pct"))


def avg_median_wait(summary: DataFrame, by: list[str]) -> DataFrame:
    """Mean of the means per month, provider and specialty."""
    key = dict.fromkeys(["period_date", "provider_org_name", "treatment_function_name", *by])
    inner = summary.groupBy(*key).agg(F.avg("avg_median_wait_weeks").alias("_mean"))
    return inner.groupBy(*by).agg(steady(F.avg("_mean")).alias("avg_median_wait_weeks"))


def avg_p92_wait(summary: DataFrame, by: list[str]) -> DataFrame:
    return summary.groupBy(*by).agg(steady(F.avg("avg_p92_wait_weeks"), 5).alias("avg_p92_wait_weeks"))


def regional_breach(summary: DataFrame, by: list[str]) -> DataFrame:
    """Filters on other region columns are lifted: the rate is per region name and the rest of the context."""
    kept = [c for c in by if c != "region_code"]
    kept = kept if "region_name" in kept else [*kept, "region_name"]
    return totals(summary, kept).select(*kept, breach_rate().alias("regional_breach_rate_pct"))


def _all_regions(by: list[str]) -> WindowSpec:
    return Window.partitionBy(*[c for c in by if not c.startswith("region_")])


def vs_national_breach(summary: DataFrame, by: list[str]) -> DataFrame:
    w = _all_regions(by)
    everywhere = percent(F.sum("waiting_over_18wks").over(w), F.sum("total_waiting").over(w), 0)
    return totals(summary, by).select(*by, (breach_rate() - everywhere).alias("vs_national_breach_rate"))


def regional_index(summary: DataFrame, by: list[str]) -> DataFrame:
    """1.0 is the mean region of the same context."""
    mean = F.avg("new_rtt_periods").over(_all_regions(by))
    return totals(summary, by).select(
        *by, steady(ratio(F.col("new_rtt_periods"), mean)).alias("regional_referral_index")
    )


def rolling(summary: DataFrame, by: list[str], c: str, months: int, name: str) -> DataFrame:
    """Mean of the months present among the last `months` calendar months."""
    w = _calendar(by).rangeBetween(1 - months, 0)
    return _months(summary, by).select("period_date", *by, steady(F.avg(c).over(w)).alias(name))


def fytd_treated(summary: DataFrame, by: list[str]) -> DataFrame:
    w = Window.partitionBy(*by, "financial_year").orderBy("_m").rowsBetween(Window.unboundedPreceding, 0)
    framed = calendar.with_attributes(_months(summary, by), ["financial_year"])
    return framed.select(
        "period_date", "financial_year", *by, F.sum("total_completed").over(w).alias("fytd_treated")
    )
