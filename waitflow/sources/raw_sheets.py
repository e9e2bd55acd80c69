"""Raw sheets written from the pathway rows: text cells and stray rows, and broken copies of some sheets beside them.

They stand in for the published spreadsheets, so that cleaning and ingest run on the given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.plans.facts import GRAIN

SUPPRESSED = "*"
INCOMPLETE_TOTAL = "Total number of incomplete pathways"
COMPLETED_TOTAL = "Total number of completed pathways (all)"
NEW_TOTAL = "Number of new RTT clock starts during the month"
MEDIAN = "Average (median) waiting time (in weeks)"
P92 = "92nd percentile waiting time (in weeks)"
BASE_HEADINGS = ["Region Code", "Provider Code", "Provider Name", "Treatment Function Code", "Treatment Function"]
WEEK_HEADINGS = [*S.WEEK_COLUMNS, S.OPEN_WEEK_COLUMN]
INCOMPLETE_HEADINGS = [*BASE_HEADINGS, *WEEK_HEADINGS, INCOMPLETE_TOTAL]


def weekly_sums(rows: DataFrame, grain: list[str] = GRAIN) -> DataFrame:
    """The 53 weekly columns of waiting patients, in one aggregate."""
    cells = [F.expr(f"sum(if(wait_week = {i}, patients, null)) AS `{h}`") for i, h in enumerate(WEEK_HEADINGS)]
    return rows.filter("is_open").groupBy(*grain).agg(*cells, F.sum("patients").alias(INCOMPLETE_TOTAL))


def week_maps(rows: DataFrame, grain: list[str] = GRAIN, dealt_by: list[str] | None = None) -> DataFrame:
    """Waiting patients by week as a map of the weeks that have any row, with the total.

    Most cells have one or two weeks, so a map is much less to aggregate and to shuffle than 53 columns. Rows are
    summed by week before they are gathered, so a map has 53 entries at most.

    dealt_by: columns of the grain by which the sums by week are dealt out, so that this and any later grouping by
    a grain that has these columns needs no further shuffle.
    """
    weeks = rows.filter("is_open").groupBy(*grain, "wait_week").agg(F.sum("patients").alias("n"))
    weeks = weeks.repartition(*dealt_by) if dealt_by else weeks
    entry = F.when(F.col("wait_week").isNotNull(), F.struct("wait_week", "n"))
    return weeks.groupBy(*grain).agg(
        F.map_from_entries(F.collect_list(entry)).alias("weeks"), F.sum("n").alias(INCOMPLETE_TOTAL)
    )


def _cell(name: str) -> Column:
    """Blank for nothing, the number otherwise."""
    return F.expr(f"coalesce(CAST(`{name}` AS STRING), '') AS `{name}`")


def _base(df: DataFrame) -> list[Column]:
    names = ["region_code", "provider_org_code", "provider_org_name", "treatment_function_code"]
    return [F.col(n).alias(h) for n, h in zip([*names, "treatment_function_name"], BASE_HEADINGS)]


def _file(kind: str, month: Column) -> Column:
    return F.concat(F.lit(f"{kind}-"), F.date_format(month, "MMMyy"), F.lit(".csv")).alias("source_file")


def with_stray_rows(df: DataFrame) -> DataFrame:
    """Repeats each row under a total heading and under a lower-case code, as footers do."""
    code = F.col("provider_org_code")
    return df.withColumn("provider_org_code", F.explode(F.array(code, F.lit("Total"), F.lower(code))))


def incomplete_sheet(weekly: DataFrame) -> DataFrame:
    """Wide text sheet; `weekly` carries provider and specialty labels."""
    month = F.col("period_date")
    return with_stray_rows(weekly).select(
        *_base(weekly),
        *[_cell(h) for h in WEEK_HEADINGS],
        F.col(f"`{INCOMPLETE_TOTAL}`").cast("double").cast("string").alias(INCOMPLETE_TOTAL),
        F.date_format(month, "MMMM yyyy").alias("period_date"),
        _file("Incomplete-Provider", month),
    )


def completed_sheet(completed: DataFrame, kind: str) -> DataFrame:
    month = F.col("period_date")
    return with_stray_rows(completed).select(
        *_base(completed),
        F.col("total_completed").cast("string").alias(COMPLETED_TOTAL),
        F.col("median_wait_weeks").cast("string").alias(MEDIAN),
        F.col("percentile_92_wait_weeks").cast("string").alias(P92),
        F.date_format(month, "MMMM yyyy").alias("period_date"),
        _file(kind, month),
    )


def new_periods_sheet(new: DataFrame) -> DataFrame:
    month = F.col("period_date")
    return with_stray_rows(new).select(
        *_base(new),
        F.col("new_rtt_periods").cast("double").cast("string").alias(NEW_TOTAL),
        F.date_format(month, "MMMM yyyy").alias("period_date"),
        _file("New-Periods-Provider", month),
    )


def _text(period: Column | str, headings: Column, lines: Column) -> Column:
    preamble = [F.lit("Statistics")] + [F.lit(",,")] * (S.PERIOD_ROW - 1)
    preamble += [F.concat(F.lit(",Period:,"), period)] + [F.lit(",,")] * (S.HEADER_ROW - S.PERIOD_ROW - 1)
    return F.array_join(F.concat(F.array(*preamble), headings, lines), "\n")


def _week_cells(weeks: str) -> Column:
    """The weekly cells of a map as one text: its entries by week, each behind the commas since the one before.

    Weeks without an entry, which are nearly all, cost nothing but their comma.
    """
    last = len(WEEK_HEADINGS) - 1
    entries = F.filter(F.sort_array(F.map_entries(weeks)), lambda e: e["key"].between(0, last))

    def add(done: Column, e: Column) -> Column:
        number = F.coalesce(e["value"].cast("string"), F.lit(""))
        text = F.concat(done["text"], F.repeat(F.lit(","), e["key"] - done["week"]), number)
        return F.struct(text.alias("text"), e["key"].alias("week"))

    none = F.struct(F.lit("").alias("text"), F.lit(0).alias("week"))
    end = lambda done: F.concat(done["text"], F.repeat(F.lit(","), F.lit(last) - done["week"]))
    return F.coalesce(F.aggregate(entries, none, add, end), F.lit("," * last))


def sheet_texts(weekly: DataFrame) -> DataFrame:
    """One text per provider and month, with preamble, and broken copies of some. A text holds a line per specialty.

    `weekly` has the weeks as a map and carries provider and specialty labels.
    """
    line = F.concat_ws(",", *_base(weekly), _week_cells("weeks"), F.col(f"`{INCOMPLETE_TOTAL}`").cast("string"))
    grouped = weekly.groupBy("period_date", "provider_org_code", "provider_id").agg(
        F.sort_array(F.collect_list(line)).alias("lines")
    )
    month = F.col("period_date")
    name = F.concat(F.lit("Incomplete-Provider-"), "provider_org_code", F.lit("-"), F.date_format(month, "MMMyy"))
    headings = F.array(F.lit(",".join(f'"{h}"' for h in INCOMPLETE_HEADINGS)))
    period = F.date_format(month, "MMMM yyyy")
    good = F.struct(F.concat(name, F.lit(".csv")).alias("file_name"), _text(period, headings, F.col("lines")).alias("content"))
    versions = F.array(good, _broken_copy(name, period, headings, F.col("lines")))
    return grouped.select(F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("v")).select("v.*")


def is_copied(provider_id: Column, month: Column) -> Column:
    """Every provider has a broken copy of its sheet once a year, in a month that its id decides."""
    return (provider_id + F.month(month)) % 12 == 0


def _broken_copy(name: Column, period: Column, headings: Column, lines: Column) -> Column:
    """A second version of a sheet without a readable period, without a header, without lines, or cut in its preamble;
    NULL for sheets that have none."""
    none = F.array().cast("array<string>")
    whole = _text(period, headings, lines)
    texts = [
        _text(F.lit("Unknown"), headings, lines),
        _text(period, none, lines),
        _text(period, headings, none),
        F.substring_index(whole, "\n", S.HEADER_ROW - 2),
    ]
    fault = F.year("period_date") % len(texts)
    content = F.coalesce(*[F.when(fault == i, t) for i, t in enumerate(texts)])
    copy = F.struct(F.concat(name, F.lit("-copy.csv")).alias("file_name"), content.alias("content"))
    return F.when(is_copied(F.col("provider_id"), F.col("period_date")), copy)
