"""Mart frames on top of the activity frame (facts.activity or facts.activity_from_facts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.functions import calendar
from waitflow.functions.numeric import percent, ratio, zero

MEASURES = [
    "total_waiting",
    "waiting_over_18wks",
    "waiting_over_52wks",
    "completed_admitted",
    "completed_non_admitted",
    "total_completed",
    "new_rtt_periods",
]
NATIONAL = ["total_waiting", "waiting_over_18wks", "waiting_over_52wks", "total_completed", "new_rtt_periods"]


def monthly_summary(activity: DataFrame) -> DataFrame:
    """Month x provider x specialty, driven by the waiting list: keys without anyone waiting are left out.

    The average waits are there when the activity frame was built with waits.
    """
    waits = {"waiting_median": "avg_median_wait_weeks", "waiting_p92": "avg_p92_wait_weeks"}
    return activity.filter("n_incomplete > 0").withColumnsRenamed(waits)


def sums(names: list[str] = NATIONAL) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def derived(df: DataFrame) -> DataFrame:
    """Net change, treatments per referral and breach rate of a summed frame."""
    return df.withColumns(
        {
            "net_list_change": F.col("new_rtt_periods") - F.col("total_completed"),
            "treatment_per_referral_ratio": ratio(F.col("total_completed"), F.col("new_rtt_periods")),
            "breach_rate_pct": percent(F.col("waiting_over_18wks"), F.col("total_waiting")),
        }
    )


def national_monthly(summary: DataFrame) -> DataFrame:
    """One row per month. Everything built on it is bounded by the number of months."""
    return derived(summary.groupBy("period_date").agg(*sums()))


def month_totals(activity: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Month totals over every key, waiting or not; NULL where a fact has no row in the group."""
    present = {"total_waiting": "n_incomplete", "total_completed": "n_completed", "new_rtt_periods": "n_new"}
    counts = {m: F.sum(F.when(F.col(n) > 0, F.col(m))) for m, n in present.items()}
    return activity.groupBy("period_date", *(by or [])).agg(*[c.alias(m) for m, c in counts.items()])


def dense_monthly(
    activity: DataFrame, providers: DataFrame, specialties: DataFrame, start: Column | str, end: Column | str
) -> DataFrame:
    """Zero-filled grid of month x provider x specialty, from the first to the last month given.

    The months of a pair of provider and specialty are gathered in one row (as many as there are months), the pairs
    are completed by one join, and the grid is exploded last, so that neither a shuffle nor a join sees its rows. The
    specialty list is a scalar taken from the dimension: it has as many entries as there are specialties.
    """
    codes = specialties.agg(F.array_sort(F.collect_set("treatment_function_code")).alias("codes")).scalar()
    start, end = (F.lit(m).cast("date") if isinstance(m, str) else m for m in (start, end))
    pair = ["provider_id", "treatment_function_code"]
    values = {m: F.col(m) for m in MEASURES}
    for name in ("median", "p92"):
        mean = F.col(f"completed_{name}_sum") / F.nullif(F.col(f"completed_{name}_n"), F.lit(0))
        values[f"avg_{name}_wait_weeks"] = mean
    cell = F.struct("period_date", F.struct(*[c.alias(n) for n, c in values.items()]))
    months = activity.groupBy(*pair).agg(F.map_from_entries(F.collect_list(cell)).alias("cells"))
    grid = providers.withColumn("treatment_function_code", F.explode(codes)).join(months, pair, "left")
    month = F.explode(F.sequence(start, end, F.expr("interval 1 month"))).alias("period_date")
    rows = grid.select(*pair, "cells", month).withColumn("cell", F.try_element_at("cells", F.col("period_date")))
    filled = [(zero(F.col(f"cell.{n}")) if n in MEASURES else F.col(f"cell.{n}")).alias(n) for n in values]
    return rows.select("period_date", *pair, *filled)


def align_series(waiting: DataFrame, treated: DataFrame, referrals: DataFrame) -> DataFrame:
    """Full outer alignment of three month series (one row per month each)."""
    return waiting.join(treated, "period_date", "full_outer").join(referrals, "period_date", "full_outer")


def in_months(start: str, end: str) -> Column:
    return calendar.between_months(F.col("period_date"), start, end)


def since(start: str = S.BASELINE_START) -> Column:
    return F.col("period_date") >= F.lit(start).cast("date")
