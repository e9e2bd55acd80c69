"""Distinct counts that merge: one small sketch per month and source, stored, and united for any longer period.

An exact distinct count over a year cannot be had from the counts of its months. A HyperLogLog sketch of 2 ** LOG_K
registers can: its union is the sketch of all rows, and its relative standard error is about 1.04 / 2 ** (LOG_K / 2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_K = 12
STANDARD_ERROR = 1.04 / 2 ** (LOG_K / 2)


def monthly(cells: DataFrame, by: list[str], counted: dict[str, list[str]]) -> DataFrame:
    """by and one sketch column for each group of columns whose distinct combinations are counted."""
    text = {n: F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cs]) for n, cs in counted.items()}
    return cells.groupBy(*by).agg(*[F.hll_sketch_agg(t, F.lit(LOG_K)).alias(n) for n, t in text.items()])


def united(sketches: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """Estimated distinct counts of coarser groups, from stored sketches alone."""
    return sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in names])


def within_bound(estimate: Column, exact: Column, errors: float = 4.0) -> Column:
    """Whether an estimate is no further off than so many standard errors (one, for tiny counts)."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), F.lit(errors * STANDARD_ERROR) * exact)
