"""Month-grain calendar expressions. All take a DATE column holding the first of a month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waitflow import schemas as S


def date_key(d: Column) -> Column:
    return (F.year(d) * 100 + F.month(d)).cast("int")


def month_index(d: Column) -> Column:
    """Running month number, so that a calendar shift is an integer RANGE frame."""
    return (F.year(d) * 12 + F.month(d)).cast("int")


def _fiscal(d: Column) -> Column:
    # April becomes January, so the fiscal year and quarter are plain date parts.
    return F.add_months(d, -3)


def _two_digits(year: Column) -> Column:
    return F.lpad((year % 100).cast("string"), 2, "0")


def financial_year(d: Column) -> Column:
    y = F.year(_fiscal(d))
    return F.concat(y.cast("string"), F.lit("/"), _two_digits(y + 1))


def financial_quarter(d: Column) -> Column:
    y = F.year(_fiscal(d))
    quarter = F.quarter(_fiscal(d)).cast("string")
    return F.concat(F.lit("Q"), quarter, F.lit(" "), _two_digits(y), _two_digits(y + 1))


def fy_slug(start_year: Column) -> Column:
    return F.concat(start_year.cast("string"), F.lit("-"), _two_digits(start_year + 1))


def between_months(d: Column, start: str, end: str) -> Column:
    return d.between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def is_covid(d: Column) -> Column:
    return between_months(d, S.COVID_START, S.COVID_END)


def attributes(d: Column) -> dict[str, Column]:
    """Every calendar attribute of a month, by name."""
    return {
        "date_key": date_key(d),
        "full_date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "financial_year": financial_year(d),
        "financial_quarter": financial_quarter(d),
        "is_covid_period": is_covid(d).cast("int"),
    }


def with_attributes(df: DataFrame, names: list[str], date_column: str = "period_date") -> DataFrame:
    """Calendar attributes computed in place: no join with the date dimension is needed."""
    found = attributes(F.col(date_column))
    return df.withColumns({n: found[n] for n in names})


def months(spark: SparkSession, start: str = S.CALENDAR_START, end: str = S.CALENDAR_END) -> DataFrame:
    """One row per month between two dates, both included."""
    return spark.range(1).select(
        F.explode(
            F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 month"))
        ).alias("full_date")
    )
