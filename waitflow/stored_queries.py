"""Queries that write tables or files to the session's warehouse and answer from what they read back."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitflow import schemas as S
from waitflow.data import Data
from waitflow.functions import calendar
from waitflow.operators import clean, keys
from waitflow.plans import dims, facts, loads, marts, quality, sketches, stars, waits
from waitflow.sources import buckets, files, raw_sheets, tables, workspace
from waitflow.sources.increments import Ingest
from waitflow.sources.pathways import pathways

QUERIES: list[Callable[[Data], DataFrame]] = []


def query(fn: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
    QUERIES.append(fn)
    return fn


# --- batches, reloads and refreshed marts --------------------------------------------------------------

# Years from here on were first published in a provisional state and are loaded again.
PROVISIONAL_FROM = "2023-04-01"


def _flat(d: Data, kind: str, start: str | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Facts of one kind with the provider's code, from given rows or those of the tables; a start month reaches the scan."""
    build = {"incomplete": facts.incomplete, "completed": facts.completed, "new_periods": facts.new_periods}[kind]
    if rows is None:
        rows = d.rows(start=start)
    elif start is not None:
        rows = rows.filter(F.col("period_date") >= F.lit(start).cast("date"))
    return d.coded(build(rows)).drop("provider_id")


def _stored_rows(d: Data) -> DataFrame:
    """Pathway rows with their period and specialty, joined once and written, for several facts and loads."""
    path = workspace.folder(d.spark, "rows")
    rows = d.rows().drop("l_orderkey", "l_linenumber")
    tables.write_table(rows, path)
    return tables.read_stored(d.spark, path, rows)


def _provisional(rows: DataFrame) -> DataFrame:
    """Rows with late years as first published: every month dated one too late, and only the codes that end in a digit."""
    late = F.col("period_date") >= F.lit(PROVISIONAL_FROM).cast("date")
    known = rows.filter(~late | F.col("provider_org_code").rlike("[0-9]$"))
    return known.withColumn("period_date", F.when(late, F.add_months("period_date", 1)).otherwise(F.col("period_date")))


def _batches(rows: DataFrame) -> list[str]:
    """Names of the staged batches: one for each financial year."""
    return sorted(r[0] for r in rows.select(loads.BATCH).distinct().collect())


def _load_and_reload(d: Data, stored: loads.Facts, kind: str) -> tuple[DataFrame, list[int]]:
    """Loads every year as a batch, then the provisional ones again in their final state."""
    rows = _flat(d, kind)
    month = F.col("period_date")
    batch = loads.batch_name(kind, month)
    stored.stage(kind, _provisional(rows.withColumn("_batch", batch)), F.col("_batch"))
    staged = stored.staged(kind, rows).drop("_batch")
    stored.load(kind, staged, _batches(staged))
    stored.stage(kind, _flat(d, kind, PROVISIONAL_FROM), batch)
    staged = stored.staged(kind, rows)
    return rows, stored.load(kind, staged, _batches(staged))


def _stored(d: Data) -> loads.Facts:
    return loads.Facts(d.spark, workspace.folder(d.spark, "facts"))


@query
def load_batches_reloaded(d: Data) -> DataFrame:
    """The stored waiting facts after all batches were loaded and the provisional ones loaded again."""
    stored = _stored(d)
    rows, _ = _load_and_reload(d, stored, "incomplete")
    kept = [*S.CELL_KEY, *S.BAND_COLUMNS, "total_waiting", loads.BATCH, "date_key", "data_source"]
    return stored.read("incomplete", rows).select(*kept, F.col("load_timestamp").isNotNull().alias("is_loaded"))


@query
def load_touched_months(d: Data) -> DataFrame:
    """Months that the reload touched: those it brought and those it took away, with the rows they hold now."""
    stored = _stored(d)
    rows, touched = _load_and_reload(d, stored, "new_periods")
    held = stored.read("new_periods", rows, touched).groupBy("date_key").agg(F.count(F.lit(1)).alias("n_rows"))
    months = d.spark.createDataFrame([(m,) for m in touched], "date_key int")
    return months.join(held, "date_key", "left").select("date_key", F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"))


def _refreshed(d: Data) -> str:
    """Loads all facts, builds the marts, reloads the late years and refreshes their months; prefix of the views."""
    stored = _stored(d)
    source = _stored_rows(d)
    rows = {k: _flat(d, k, rows=source) for k in loads.KINDS}
    built = loads.Marts(stored, rows)
    for kind in loads.KINDS:
        batch = loads.batch_name(kind, F.col("period_date"))
        stored.stage(kind, _provisional(rows[kind].withColumn("_batch", batch)), F.col("_batch"))
        staged = stored.staged(kind, rows[kind])
        stored.load(kind, staged, _batches(staged))
    built.refresh_pending()
    for kind in loads.KINDS:
        stored.stage(kind, _flat(d, kind, PROVISIONAL_FROM, source), loads.batch_name(kind, F.col("period_date")))
        staged = stored.staged(kind, rows[kind])
        stored.load(kind, staged, _batches(staged))
    built.refresh_pending()
    prefix = f"v_{uuid4().hex}"
    built.open_views(prefix)
    return prefix


@query
def mart_refreshed(d: Data) -> DataFrame:
    """The monthly mart after the refresh of the touched months, read through its view."""
    view = f"{_refreshed(d)}_monthly_summary"
    return d.spark.sql(
        f"SELECT period_date, provider_org_code, treatment_function_code, {', '.join(marts.MEASURES)} "
        f"FROM {view} WHERE n_incomplete > 0"
    )


@query
def mart_refreshed_national(d: Data) -> DataFrame:
    """The national mart after the refresh, by SQL over its view."""
    view = f"{_refreshed(d)}_national_monthly"
    columns = [*marts.NATIONAL, "net_list_change", "treatment_per_referral_ratio", "breach_rate_pct"]
    return d.spark.sql(f"SELECT period_date, {', '.join(columns)} FROM {view}")


def _covid_facts(d: Data) -> DataFrame:
    """Stored waiting facts of the COVID months: the calendar's filter decides which partitions are read."""
    stored = _stored(d)
    rows = _flat(d, "incomplete")
    stored.stage("incomplete", rows, loads.batch_name("incomplete", F.col("period_date")))
    staged = stored.staged("incomplete", rows)
    stored.load("incomplete", staged, _batches(staged))
    calendar_path = f"{stored.folder}/dim_date"
    tables.write_table(d.dim_date(), calendar_path)
    months = tables.read_stored(d.spark, calendar_path, d.dim_date()).filter("is_covid_period = 1")
    return stored.read("incomplete", rows).join(months.select("date_key", "financial_quarter"), "date_key")


@query
def slice_stored_facts(d: Data) -> DataFrame:
    """Waiting patients by quarter of the COVID months, from the stored facts of these months only."""
    sums = [F.sum(c).alias(c) for c in ("total_waiting", S.LONG_COLUMN)]
    return _covid_facts(d).groupBy("financial_quarter").agg(*sums, F.count(F.lit(1)).alias("n_rows"))


@query
def fact_appended(d: Data) -> DataFrame:
    """The completed facts appended pathway by pathway to a table by financial year, read back."""
    path = workspace.folder(d.spark, "completed")
    rows = calendar.with_attributes(d.completed().drop("provider_id"), ["financial_year"])
    rows = rows.withColumn("financial_year", F.replace("financial_year", F.lit("/"), F.lit("-")))
    for pathway in (S.ADMITTED, S.NON_ADMITTED):
        tables.append_table(rows.filter(F.col("pathway_type") == pathway), path, ["financial_year"])
    return tables.read_stored(d.spark, path, rows)


# --- star tables with unmatched keys -------------------------------------------------------------------


def _partial_dimensions(d: Data) -> dict[str, DataFrame]:
    """Dimensions that lack every tenth provider and the last specialty, as before a late update."""
    found = d.dimensions()
    last = found["dim_treatment_function"].agg(F.max("treatment_function_key").alias("k")).scalar()
    return found | {
        "dim_trust": found["dim_trust"].filter("trust_key % 10 <> 0"),
        "dim_treatment_function": found["dim_treatment_function"].filter(F.col("treatment_function_key") < last),
    }


def _unmatched_stars(d: Data, rows: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four star tables, from given pathway rows or those of the tables."""
    found = _partial_dimensions(d)
    rows = d.rows() if rows is None else rows
    incomplete = d.coded(facts.incomplete(rows))
    return {
        "fact_rtt_incomplete_star": stars.star_incomplete(incomplete, found),
        "fact_rtt_completed_star": stars.star_completed(d.coded(facts.completed(rows)), found),
        "fact_rtt_new_periods_star": stars.star_new_periods(d.coded(facts.new_periods(rows)), found),
        "fact_rtt_wait_band_star": stars.star_wait_band(incomplete, found),
    }


@query
def dq_missing_keys_at_load(d: Data) -> DataFrame:
    """NULL keys of the four star tables, counted while they are written; some keys have no dimension row."""
    return quality.write_checked(_unmatched_stars(d, _stored_rows(d)), workspace.folder(d.spark, "stars"))


@query
def star_new_periods_unmatched(d: Data) -> DataFrame:
    """The new-period star with unmatched keys, written and read back: unresolved rows stay."""
    path = workspace.folder(d.spark, "star")
    star = _unmatched_stars(d)["fact_rtt_new_periods_star"]
    tables.write_table(star, path)
    return tables.read_stored(d.spark, path, star)


@query
def star_wait_band_unmatched(d: Data) -> DataFrame:
    """The wait-band star with unmatched keys, written and read back: only resolved rows are there."""
    path = workspace.folder(d.spark, "star")
    star = _unmatched_stars(d)["fact_rtt_wait_band_star"]
    tables.write_table(star, path)
    return tables.read_stored(d.spark, path, star)


# --- CSV files -----------------------------------------------------------------------------------------


def _new_periods_rows(d: Data) -> DataFrame:
    """Processed new-period rows; the file is named after the month."""
    rows = d.label(facts.new_periods(d.rows()))
    month = F.col("period_date")
    file = F.concat(F.lit("New-Periods-Provider-"), F.date_format(month, "MMMyy"))
    rows = rows.withColumns({"file": file, "source_file": F.concat(file, F.lit(".csv"))})
    return rows.withColumn("period_date", F.date_format(month, "yyyy-MM-dd"))


@query
def csv_fixed_schema(d: Data) -> DataFrame:
    """Waiting rows written as CSV with commas, quotes and line feeds in their names, and scanned by a fixed schema."""
    path = workspace.folder(d.spark, "csv")
    name = F.concat("provider_org_name", F.lit(', "The"\nTrust'))
    rows = d.sourced(d.label(facts.incomplete(d.rows())), "Incomplete-Provider").withColumns(
        {"period_date": F.date_format("period_date", "yyyy-MM-dd"), "provider_org_name": name}
    )
    files.write_processed(rows.select(*S.INCOMPLETE_CSV.fieldNames()), path)
    scanned = files.scan_csv(d.spark, path, S.INCOMPLETE_CSV, multi_line=True)
    return files.fitting(scanned).drop("file_path")


@query
def csv_all_text(d: Data) -> DataFrame:
    """New-period sheets with stray rows written as CSV, scanned as text, and cleaned."""
    path = workspace.folder(d.spark, "csv")
    sheet = raw_sheets.new_periods_sheet(d.label(facts.new_periods(d.rows())))
    files.write_processed(sheet, path)
    scanned = files.scan_csv(d.spark, path, S.as_text(sheet.schema))
    return clean.silver_new_periods(files.fitting(scanned))


def _broken_line(line: Column, which: Column) -> Column:
    """A line of eight cells with the last one cut off, one more cell, or a suppressed count."""
    cut = F.regexp_replace(line, ",[^,]*$", "")
    starred = F.regexp_replace(line, ",[0-9]+,([0-9-]+,[^,]*)$", f",{raw_sheets.SUPPRESSED},$1")
    return F.when(which == 0, cut).when(which == 1, F.concat(line, F.lit(",more"))).otherwise(starred)


def _scanned_with_faults(d: Data) -> DataFrame:
    """New-period files by month in which the lines of every seventh provider are given once more, broken."""
    path = workspace.folder(d.spark, "csv")
    rows = _new_periods_rows(d)
    columns = S.NEW_PERIODS_CSV.fieldNames()
    line = F.array_join(F.array(*[F.col(c).cast("string") for c in columns]), ",")
    which = F.when(F.col("provider_id") % 7 == 0, F.floor(F.col("provider_id") / 7) % 3)
    # A line and its broken version come from one row, so that the rows are computed once.
    both = F.array(F.struct(F.lit(1).alias("position"), line.alias("line")), F.struct(F.lit(2).alias("position"), _broken_line(line, which).alias("line")))
    lines = rows.select("file", F.inline(F.when(which.isNull(), F.slice(both, 1, 1)).otherwise(both)))
    files.write_lines(lines, path, ",".join(columns))
    return files.scan_csv(d.spark, path, S.NEW_PERIODS_CSV, pattern="*")


@query
def csv_rejects(d: Data) -> DataFrame:
    """Records of the new-period files that do not fit the schema, by file, with the reason."""
    found = files.rejected(_scanned_with_faults(d), S.NEW_PERIODS_CSV)
    return found.select(files.file_of(F.col("file_path")).alias("file"), "record", "reason")


@query
def csv_kept(d: Data) -> DataFrame:
    """Rows of the same files that fit: none is lost beside the broken ones."""
    kept = files.fitting(_scanned_with_faults(d))
    return kept.withColumn("file", files.file_of(F.col("file_path"))).drop("file_path")


@query
def csv_combined(d: Data) -> DataFrame:
    """Two publications of the new periods combined: the first file that has a key gives the row.

    The first publication lacks every third provider; the second has all, with counts one higher.
    """
    path = workspace.folder(d.spark, "csv")
    rows = _new_periods_rows(d)
    first = rows.filter("provider_id % 3 <> 0").withColumn("source_file", F.concat(F.lit("1-"), "source_file"))
    second = rows.withColumns(
        {"source_file": F.concat(F.lit("2-"), "source_file"), "new_rtt_periods": F.col("new_rtt_periods") + 1}
    )
    for n, publication in enumerate((first, second)):
        files.write_processed(publication.select(*S.NEW_PERIODS_CSV.fieldNames()), f"{path}/{n}")
    scanned = files.fitting(files.scan_csv(d.spark, path, S.NEW_PERIODS_CSV))
    return clean.combine(scanned.drop("file_path"), ["source_file", "new_rtt_periods"])


# --- incremental ingest --------------------------------------------------------------------------------

# Months up to here are there at the first run; the rest, and new versions of the COVID months, come later.
FIRST_UNTIL = "2022-03-01"
_INGESTED = "period_date string, provider_org_code string, treatment_function_code string, new_rtt_periods long"


def _drop_files(rows: DataFrame, path: str) -> None:
    """One file for each month below a folder."""
    columns = [c.split(" ")[0] for c in _INGESTED.split(", ")]
    line = F.array_join(F.array(*[F.col(c).cast("string") for c in columns]), ",")
    files.write_lines(rows.select("file", F.lit(1).alias("position"), line.alias("line")), path, ",".join(columns))


def _ingested(d: Data) -> Ingest:
    """Three runs over a growing folder: first months; later months and changed COVID months; nothing new."""
    root, store = workspace.folder(d.spark, "incoming"), workspace.folder(d.spark, "ingested")
    schema = T.StructType.fromDDL(_INGESTED)
    read = lambda paths: files.fitting(files.scan_csv(d.spark, paths, schema, pattern="*"))
    ingest = Ingest(d.spark, root, store, read, pattern="part-*")
    rows = _new_periods_rows(d)
    month = F.col("period_date").cast("date")
    early, covid = month <= F.lit(FIRST_UNTIL).cast("date"), calendar.is_covid(month)
    _drop_files(rows.filter(early & ~covid), f"{root}/early")
    _drop_files(rows.filter(covid).withColumn("new_rtt_periods", F.lit(0)), f"{root}/covid")
    ingest.run()
    workspace.remove(d.spark, f"{root}/covid")
    _drop_files(rows.filter(covid), f"{root}/covid")
    _drop_files(rows.filter(~early), f"{root}/late")
    ingest.run()
    ingest.run()
    return ingest


@query
def ingest_incremental(d: Data) -> DataFrame:
    """Rows after three runs over a folder that has grown and changed."""
    rows = _ingested(d).rows(_INGESTED)
    return rows.select(*S.CELL_KEY, "new_rtt_periods", files.file_of(F.col("file_path")).alias("file"), "run")


@query
def ingest_incremental_runs(d: Data) -> DataFrame:
    """What each run listed and read; the third one reads nothing."""
    return _ingested(d).runs()


# --- dimensions and waits ------------------------------------------------------------------------------


@query
def dim_trust_first_seen(d: Data) -> DataFrame:
    """Providers that change their name every year; the name of the first file that has the code counts."""
    seen = d.label(d.rows(specialty=False).groupBy("period_date", "provider_id").agg(F.lit(1).alias("one")))
    named = seen.withColumn("provider_org_name", F.concat("provider_org_name", F.lit(" "), F.year("period_date").cast("string")))
    return dims.dim_trust(named, d.dim_region(), ["period_date", "provider_org_name"])


def _known_trusts(d: Data) -> DataFrame:
    """Providers in credit, known under their present name (even ids) or an older one, all in the first region."""
    known = d.table("supplier").filter("s_acctbal > 0")
    name = F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).otherwise(F.concat(F.lit("old "), F.col("s_name")))
    rows = known.select(F.col("s_suppkey").alias("provider_id"), name.alias("trust_name"), F.lit(1).alias("region_key"))
    return d.coded(rows).withColumnRenamed("provider_org_code", "trust_code").drop("provider_id")


@query
def dim_trust_changes(d: Data) -> DataFrame:
    """What the providers of the data change in a list of known ones."""
    return keys.change_set(_known_trusts(d), d.dim_trust(), "trust_code", ["trust_name", "region_key"])


def _named_by_month(d: Data) -> DataFrame:
    """Provider names by month: a provider takes a new name in the April of every second financial year."""
    seen = d.rows(specialty=False).groupBy("period_date", "provider_id").agg(F.lit(1).alias("one"))
    year = F.year(F.add_months("period_date", -3))
    suffix = F.concat(F.lit(" v"), F.floor((year - 2019) / 2).cast("string"))
    return d.label(seen).withColumn("trust_name", F.concat("provider_org_name", suffix))


@query
def dim_trust_history(d: Data) -> DataFrame:
    """How long each provider name held."""
    return keys.history(_named_by_month(d), "provider_org_code", "period_date", ["trust_name"])


@query
def fact_as_of_names(d: Data) -> DataFrame:
    """Referrals by the provider name of their month."""
    intervals = keys.history(_named_by_month(d), "provider_org_code", "period_date", ["trust_name"])
    months = d.coded(facts.new_periods(d.rows(specialty=False), ["period_date", "provider_id"]))
    named = keys.as_of(months, intervals, "provider_org_code", "period_date")
    return named.groupBy("provider_org_code", "trust_name").agg(
        F.count(F.lit(1)).alias("n_months"), F.sum("new_rtt_periods").alias("new_rtt_periods")
    )


@query
def bucketed_month_totals(d: Data) -> DataFrame:
    """National months from lines and orders that are stored in buckets of the order key."""
    lines, orders = buckets.store_orders(d.table("lineitem"), d.table("orders"))
    rows = pathways(d.spark, d.directory, specialty=False, tables={"lineitem": lines, "orders": orders})
    return marts.month_totals(facts.activity(rows, ["period_date"]))


@query
def profile_sketches(d: Data) -> DataFrame:
    """Distinct providers and cells by financial year from stored monthly sketches, beside the exact counts."""
    path = workspace.folder(d.spark, "sketches")
    counted = {"trusts": ["provider_id"], "cells": ["provider_id", "treatment_function_code"]}
    cells = d.rows().select(*facts.GRAIN).distinct()
    stored = sketches.monthly(cells, ["period_date"], counted)
    tables.write_table(stored, path)
    years = calendar.with_attributes(tables.read_stored(d.spark, path, stored), ["financial_year"])
    estimated = sketches.united(years, ["financial_year"], list(counted))
    exact = calendar.with_attributes(cells, ["financial_year"]).groupBy("financial_year").agg(
        *[F.count_distinct(*[F.col(c) for c in cs]).alias(f"n_{n}") for n, cs in counted.items()]
    )
    within = [sketches.within_bound(F.col(n), F.col(f"n_{n}")).alias(f"{n}_within_bound") for n in counted]
    return estimated.join(exact, "financial_year").select("financial_year", *[f"n_{n}" for n in counted], *within)


@query
def m_true_wait(d: Data) -> DataFrame:
    """Median and 92nd percentile wait of regions from merged wait histograms, beside the mean of the keys' values."""
    path = workspace.folder(d.spark, "waits")
    stored = waits.histograms(d.rows().filter("is_open"), facts.GRAIN)
    tables.write_table(stored, path)
    cells = tables.read_stored(d.spark, path, stored)
    by_provider = waits.merge(cells, ["provider_id"])
    regions = waits.merge(d.label(by_provider), ["region_name"])
    means = d.label(
        waits.with_quantiles(cells).groupBy("provider_id").agg(
            *[F.sum(q).alias(f"{q}_sum") for q in waits.QUANTILES], F.count(F.lit(1)).alias("n_keys")
        )
    ).groupBy("region_name").agg(
        *[(F.sum(f"{q}_sum") / F.sum("n_keys")).alias(f"mean_of_{q}") for q in waits.QUANTILES]
    )
    return waits.with_quantiles(regions).join(means, "region_name").select(
        "region_name", "n_rows", "median", "p92", *[F.round(f"mean_of_{q}", 6).alias(f"mean_of_{q}") for q in waits.QUANTILES]
    )

