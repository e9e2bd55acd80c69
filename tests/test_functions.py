import datetime as dt

import pytest
from pyspark.sql import functions as F

from waitflow.functions import calendar, numeric, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("April 2019", dt.date(2019, 4, 1)),
        (" 2019-04-01 ", dt.date(2019, 4, 1)),
        ("2019-04-17", dt.date(2019, 4, 1)),
        ("Unknown", None),
        ("Smarch 2019", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_period(spark, given, wanted):
    assert one(spark, text.parse_period(F.lit(given).cast("string"))) == wanted


@pytest.mark.parametrize("given, wanted", [("12", 12), ("12.0", 12), (" 7 ", 7), ("*", 0), ("", 0), ("1-2", 0), (None, 0)])
def test_to_count(spark, given, wanted):
    assert one(spark, numeric.to_count(F.lit(given).cast("string"))) == wanted


def test_double_sql_equals_column_form(spark):
    df = spark.createDataFrame([("12",), ("12.5",), ("*",), ("",), (None,), ("x1",)], "c string")
    rows = df.select(numeric.to_double(F.col("c")).alias("a"), F.expr(numeric.double_sql("c")).alias("b")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows] == [12.0, 12.5, None, None, None, None]


@pytest.mark.parametrize("code, kept", [("RJ1", True), ("ABC123", True), ("Total", False), ("nan", False), ("AB", False), ("ABCDEFG", False)])
def test_is_code(spark, code, kept):
    assert one(spark, text.is_code(F.lit(code))) is kept


def test_file_kind_prefers_the_longer_keyword(spark):
    names = ["NonAdmitted-Provider-Apr19.csv", "x/ADMITTED-provider.csv", "Commissioner.csv"]
    found = [one(spark, text.file_kind(F.lit(n))) for n in names]
    assert found == ["completed_non_admitted", "completed_admitted", None]


@pytest.mark.parametrize(
    "day, year, quarter, covid",
    [
        ("2019-03-01", "2018/19", "Q4 1819", 0),
        ("2019-04-01", "2019/20", "Q1 1920", 0),
        ("1999-12-01", "1999/00", "Q3 9900", 0),
        ("2020-03-01", "2019/20", "Q4 1920", 1),
        ("2022-03-01", "2021/22", "Q4 2122", 1),
        ("2022-04-01", "2022/23", "Q1 2223", 0),
    ],
)
def test_fiscal_calendar(spark, day, year, quarter, covid):
    d = F.lit(day).cast("date")
    assert one(spark, calendar.financial_year(d)) == year
    assert one(spark, calendar.financial_quarter(d)) == quarter
    assert one(spark, calendar.is_covid(d).cast("int")) == covid


def test_fy_slug(spark):
    assert one(spark, calendar.fy_slug(F.lit(2024))) == "2024-25"
    assert one(spark, calendar.fy_slug(F.lit(1999))) == "1999-00"


def test_guarded_division(spark):
    assert one(spark, numeric.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, numeric.ratio(F.lit(1), F.lit(None).cast("int"), 1.0)) == 1.0
    assert one(spark, numeric.percent(F.lit(1), F.lit(4))) == 25.0
    assert one(spark, numeric.percent(F.lit(1), F.lit(0), 0)) == 0.0
