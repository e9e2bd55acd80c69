"""Number coercion and guarded arithmetic."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(text: Column) -> Column:
    """Number or NULL; blank and suppressed cells become NULL.

    Cells without a digit are set aside first: a failing cast raises and catches an exception per cell.
    """
    clean = F.trim(text)
    return F.when(clean.rlike("[0-9]"), clean).try_cast("double")


def double_sql(cell: str) -> str:
    """to_double as SQL text, for plans with dozens of such cells."""
    return f"try_cast(CASE WHEN {cell} RLIKE '[0-9]' THEN trim({cell}) END AS DOUBLE)"


def to_count(text: Column) -> Column:
    """Whole count; whatever is no number is 0, a number out of range is NULL. '12.0' is 12."""
    number = to_double(text)
    return F.when(number.isNull(), F.lit(0).cast("long")).otherwise(number.try_cast("long"))


def zero(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(0))


def sum_columns(names: list[str]) -> Column:
    """Row-wise sum; a NULL cell counts as 0."""
    return reduce(add, [zero(n) for n in names])


def ratio(a: Column, b: Column, alternate: float | None = None) -> Column:
    """a / b in double; NULL, or the alternate, where b is 0 or NULL."""
    r = a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))
    return r if alternate is None else F.coalesce(r, F.lit(float(alternate)))


def percent(a: Column, b: Column, alternate: float | None = None) -> Column:
    """100 * a / b in double, guarded like ratio."""
    r = F.lit(100.0) * a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))
    return r if alternate is None else F.coalesce(r, F.lit(float(alternate)))


def steady(c: Column, digits: int = 6) -> Column:
    """Rounds away the last bits that depend on the order in which a sum of doubles is taken.

    A multiple of 2^-digits has no more than these digits and is taken as it is: rounding goes through a decimal text,
    which costs more than the aggregate that gives most such values.
    """
    scaled = c * F.lit(float(2**digits))
    return F.when(F.rint(scaled) == scaled, c).otherwise(F.round(c, digits))
