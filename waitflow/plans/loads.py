"""Batch loads into stored facts, and the refresh of marts by the months that a load touched.

Facts are stored by month and batch. Loading a batch again replaces that batch alone: its new months come, months it
no longer has go, and every other batch keeps its files. A mart keeps additive sums per month, so a load is followed
by a refresh that reads the touched months of the facts and replaces the same months of the mart.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitflow.functions import calendar
from waitflow.plans import facts, marts
from waitflow.sources import tables, workspace
from waitflow.sources.tables import BATCH

MONTH = "date_key"
PARTITIONS = [MONTH, BATCH]
KINDS = ["incomplete", "completed", "new_periods"]
NOTE = f"{MONTH} int, note string"


def batch_name(kind: str, month: Column) -> Column:
    """`incomplete_2021-22`: a batch holds the months of one financial year."""
    return F.concat(F.lit(f"{kind}_"), calendar.fy_slug(F.year(F.add_months(month, -3))))


@dataclass
class Facts:
    """Stored flat facts of one folder, one table for each kind, by month and batch."""

    spark: SparkSession
    folder: str

    def path(self, kind: str) -> str:
        return f"{self.folder}/fact_rtt_{kind}"

    def staging(self, kind: str) -> str:
        return f"{self.folder}/stg_rtt_{kind}"

    def stage(self, kind: str, rows: DataFrame, batch_id: str | Column) -> None:
        """Truncates the staging table and fills it with rows that are tagged with batch, source and load time."""
        dated = rows.withColumn(MONTH, calendar.date_key(F.col("period_date")))
        tables.stage(dated, self.staging(kind), batch_id, partition_by=[BATCH], within=[MONTH])

    def staged(self, kind: str, schema: DataFrame, batches: list[str] | None = None) -> DataFrame:
        rows = self.spark.read.schema(stored_schema(schema)).parquet(self.staging(kind))
        return rows if batches is None else rows.filter(F.col(BATCH).isin(batches))

    def load(self, kind: str, rows: DataFrame, batches: list[str]) -> list[int]:
        """Replaces the named batches by their staged rows; returns the months touched, before or after.

        The months are noted before anything is replaced, and the note stays until the marts are refreshed. So a load
        or refresh that breaks off is made up for by the next ones, also for months that are already gone.
        """
        scope = F.col(BATCH).isin(batches)
        keys = T.StructType([rows.schema[c] for c in PARTITIONS])
        months = {month for month, _ in tables.stored_partitions(self.spark, self.path(kind), keys, scope)}
        months |= {r[0] for r in rows.select(MONTH).distinct().collect()}
        self._note(sorted(months))
        tables.replace_scope(rows, self.path(kind), PARTITIONS, scope)
        return sorted(months)

    @property
    def _notes(self) -> str:
        return f"{self.folder}/pending"

    def _note(self, months: list[int]) -> None:
        note = uuid4().hex
        noted = self.spark.createDataFrame([(m, note) for m in months], NOTE)
        tables.append_table(noted.coalesce(1), self._notes, ["note"])

    def pending(self) -> dict[str, list[int]]:
        """Months that loads have touched since the marts were last refreshed, by note."""
        if not workspace.exists(self.spark, self._notes):
            return {}
        found: dict[str, list[int]] = {}
        for row in self.spark.read.schema(NOTE).parquet(self._notes).collect():
            found.setdefault(row.note, []).append(row[MONTH])
        return found

    def settle(self, notes: Iterable[str]) -> None:
        """Removes notes whose months have been refreshed."""
        for note in notes:
            tables.drop_partition(self.spark, self._notes, "note", note)

    def read(self, kind: str, schema: DataFrame, months: list[int] | None = None) -> DataFrame:
        """Stored rows; months prune partitions."""
        rows = self.spark.read.schema(stored_schema(schema)).parquet(self.path(kind))
        return rows if months is None else rows.filter(F.col(MONTH).isin(months))


def stored_schema(rows: DataFrame) -> str:
    """Columns of a staged or stored fact, given the frame it was staged from."""
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name not in (MONTH, BATCH, *tables.LINEAGE)]
    return ", ".join([*own, "data_source string", "load_timestamp timestamp", f"{MONTH} int", f"{BATCH} string"])


def month_sums(inc: DataFrame, done: DataFrame, new: DataFrame) -> DataFrame:
    """State of the monthly mart: one row per month, provider and specialty, with sums and counts only."""
    activity = facts.activity_from_facts(inc, done, new)
    return activity.withColumn(MONTH, calendar.date_key(F.col("period_date")))


STATE = marts.MEASURES


def national_sums(months: DataFrame) -> DataFrame:
    """State of the national mart: the month's sums over the keys that somebody waits for."""
    waiting = months.filter("n_incomplete > 0")
    return waiting.groupBy("period_date", MONTH).agg(*[F.sum(c).alias(c) for c in STATE])


@dataclass
class Marts:
    """The monthly and the national mart of stored facts, each by month."""

    facts: Facts
    likes: dict[str, DataFrame]  # a frame of each kind, for the columns

    def path(self, name: str) -> str:
        return f"{self.facts.folder}/{name}"

    def refresh(self, months: list[int]) -> None:
        """Recomputes the given months from the facts of these months and replaces them; others keep their files.

        The national mart reads the months it needs from the monthly one.
        """
        inc, done, new = (self.facts.read(k, self.likes[k], months) for k in KINDS)
        inside = F.col(MONTH).isin(months)
        sums = month_sums(inc, done, new)
        tables.replace_scope(sums, self.path("monthly"), [MONTH], inside)
        stored = tables.read_stored(self.facts.spark, self.path("monthly"), sums).filter(inside)
        tables.replace_scope(national_sums(stored), self.path("national"), [MONTH], inside)

    def refresh_pending(self) -> list[int]:
        """Refreshes all months that loads have touched since the last refresh, and returns them."""
        notes = self.facts.pending()
        months = sorted({m for found in notes.values() for m in found})
        if months:
            self.refresh(months)
        self.facts.settle(notes)
        return months

    def open_views(self, prefix: str) -> None:
        """Views of both marts over whatever is stored when they are read; ratios are taken then."""
        inc, done, new = (self.facts.read(k, self.likes[k]) for k in KINDS)
        monthly = tables.read_stored(self.facts.spark, self.path("monthly"), month_sums(inc, done, new))
        national = tables.read_stored(self.facts.spark, self.path("national"), national_sums(monthly))
        tables.create_view(monthly, f"{prefix}_monthly_summary")
        tables.create_view(marts.derived(national), f"{prefix}_national_monthly")
