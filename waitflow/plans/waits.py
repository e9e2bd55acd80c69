"""Wait histograms as a stored state: counts of 53 wait weeks in one array, which merge by adding cell by cell.

Means of medians are no medians. Histograms of keys can be stored, merged to any coarser group, and read off for exact
quantiles there, without the rows they came from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.functions.numeric import steady

CELLS = S.WEEKS + 1
QUANTILES = {"median": 0.5, "p92": 0.92}


def _weeks() -> Column:
    return F.array(*[F.lit(i) for i in range(CELLS)])


def _arrays(weeks: DataFrame, by: list[str], n_rows: Column) -> DataFrame:
    """One array of 53 counts per group from (wait_week, n) rows, of which a group has few; a NULL week has no cell."""
    entry = F.when(F.col("wait_week").isNotNull(), F.struct("wait_week", "n"))
    found = weeks.groupBy(*by).agg(F.map_from_entries(F.collect_list(entry)).alias("_weeks"), n_rows.alias("n_rows"))
    cells = F.transform(_weeks(), lambda i: F.coalesce(F.try_element_at("_weeks", i), F.lit(0).cast("long")))
    return found.select(*by, cells.alias("hist"), "n_rows")


def histograms(rows: DataFrame, grain: list[str]) -> DataFrame:
    """grain, hist (rows by wait week) and n_rows, of pathway rows. Rows are counted by week before they leave a task."""
    weeks = rows.groupBy(*grain, "wait_week").agg(F.count(F.lit(1)).alias("n"))
    return _arrays(weeks, grain, F.sum("n"))


def _occupied() -> Column:
    """Weeks of a histogram that have a row, ascending: one or two in most cells of a fact."""
    return F.filter(_weeks(), lambda i: F.get("hist", i) > 0)


def merge(hists: DataFrame, by: list[str]) -> DataFrame:
    """Histograms of coarser groups: occupied weeks are added by group and week, combined in every task before the shuffle."""
    # n_rows travels as one more entry without a week, as rows without a wait have no cell.
    entries = F.concat(
        F.array(F.struct(F.lit(None).cast("int").alias("wait_week"), F.col("n_rows").alias("n"))),
        F.transform(_occupied(), lambda i: F.struct(i.alias("wait_week"), F.get("hist", i).alias("n"))),
    )
    weeks = hists.select(*by, F.inline(entries)).groupBy(*by, "wait_week").agg(F.sum("n").alias("n"))
    return _arrays(weeks, by, F.sum(F.when(F.col("wait_week").isNull(), F.col("n"))))


def _week_at(place: Column) -> Column:
    """First week whose running count is above a place (from 0) among the sorted waits; past the last week if none is."""
    start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(CELLS).alias("week"))
    step = lambda acc, i: F.struct(
        (acc["upto"] + F.get("hist", i)).alias("upto"),
        F.when((acc["week"] == CELLS) & (acc["upto"] + F.get("hist", i) > place), i).otherwise(acc["week"]).alias("week"),
    )
    return F.aggregate("_occupied", start, step, lambda acc: acc["week"])


def quantile(q: float) -> Column:
    """Linear interpolation between the two waits around the place, as the percentile of the rows has it."""
    place = F.lit(q) * (F.col("n_rows") - 1)
    low, high = _week_at(F.floor(place)), _week_at(F.ceil(place))
    return steady(low + (high - low) * (place - F.floor(place)))


def with_quantiles(hists: DataFrame) -> DataFrame:
    found = hists.withColumn("_occupied", _occupied())
    return found.withColumns({name: quantile(q) for name, q in QUANTILES.items()}).drop("_occupied")
