"""Surrogate keys, first-seen deduplication and dimension upserts."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A prefix of a sorted code is itself sorted, so codes can be numbered prefix by prefix in parallel.
# Codes hold at most six characters from A-Z and 0-9: four leading ones give at most 36**4 + 36**3
# prefixes of at most 36**2 + 36 + 1 codes each.
PREFIX = 4


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """First row per key in a total order.

    A filter on row_number() = 1 lets Spark drop later rows before the shuffle (WindowGroupLimit), so
    a key with many copies sends one row per task.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def with_surrogate_key(df: DataFrame, code: str, key: str, bounded: bool = False) -> DataFrame:
    """Numbers distinct codes 1..n in code order without sorting them all in one task.

    Rows are numbered inside each code prefix; the prefix offset comes from the prefix counts, the only
    rows that meet in one task. `bounded` is for code lists that do not grow with the data (regions,
    specialties): they are numbered directly.
    """
    if bounded:
        return df.withColumn(key, F.row_number().over(Window.orderBy(code)))
    prefixed = df.withColumn("_prefix", F.substring(code, 1, PREFIX))
    offsets = _prefix_offsets(df, code)
    inside = F.row_number().over(Window.partitionBy("_prefix").orderBy(code))
    # Every prefix has its offset; a left join leaves both sides of it the same, so Spark computes it once.
    return (
        prefixed.join(offsets, "_prefix", "left")
        .withColumn(key, (inside + F.col("_offset")).cast("int"))
        .drop("_prefix", "_offset")
    )


def _one_per_key(df: DataFrame, key: str) -> DataFrame:
    return keep_first(df.dropna(subset=[key]), [key], [c for c in df.columns if c != key] or [key])


def _prefix_offsets(codes: DataFrame, code: str) -> DataFrame:
    """Codes before each prefix; one row per prefix meets in the window."""
    before = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    counts = codes.groupBy(F.substring(code, 1, PREFIX).alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.select("_prefix", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))


def upsert(
    existing: DataFrame, incoming: DataFrame, code: str, key: str, updated: list[str], bounded: bool = False
) -> DataFrame:
    """Known codes keep their key and take the incoming values; new codes get the next keys.

    Columns outside `updated` keep their existing value and take the incoming one only for new codes. Incoming rows
    without a code are refused; of several rows with one code the first by their values counts. Known and new codes
    come out of one join; only the codes are read once more, to count the new ones before each prefix.
    """
    incoming = _one_per_key(incoming, code)
    others = [c for c in existing.columns if c not in (code, key)]
    old = existing.select(code, key, *[F.col(c).alias(f"_old_{c}") for c in others], F.lit(True).alias("_known"))
    new = incoming.select(code, *[F.col(c).alias(f"_new_{c}") for c in others if c in incoming.columns])
    merged = old.join(new, code, "full_outer")
    values = []
    for c in others:
        if c not in incoming.columns:
            values.append(F.col(f"_old_{c}").alias(c))
        elif c in updated:
            values.append(F.coalesce(f"_new_{c}", f"_old_{c}").alias(c))
        else:
            values.append(F.coalesce(f"_old_{c}", f"_new_{c}").alias(c))
    top = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("top")).scalar()
    if bounded:
        place = F.row_number().over(Window.partitionBy("_known").orderBy(code))
    else:
        fresh = incoming.select(code).join(existing.select(code), code, "left_anti")
        merged = merged.withColumn("_prefix", F.substring(code, 1, PREFIX))
        merged = merged.join(_prefix_offsets(fresh, code), "_prefix", "left")
        inside = F.row_number().over(Window.partitionBy("_prefix", "_known").orderBy(code))
        place = inside + F.coalesce("_offset", F.lit(0))
    own = F.when(F.col("_known"), F.col(key)).otherwise(top + place).cast("int")
    return merged.select(own.alias(key), code, *values)


CHANGES = ["inserted", "changed", "unchanged", "absent"]


def change_set(existing: DataFrame, incoming: DataFrame, code: str, tracked: list[str]) -> DataFrame:
    """code, change, and the old and the new value of each tracked column, from one join.

    A code is inserted, changed in a tracked column (NULL counts as a value), unchanged, or absent from the incoming
    rows. Incoming rows are taken as by upsert().
    """
    new = _one_per_key(incoming.select(code, *tracked), code)
    old = existing.select(code, *[F.col(c).alias(f"old_{c}") for c in tracked], F.lit(True).alias("_known"))
    new = new.select(code, *[F.col(c).alias(f"new_{c}") for c in tracked], F.lit(True).alias("_given"))
    same = reduce(and_, [F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in tracked])
    change = (
        F.when(F.col("_known").isNull(), "inserted")
        .when(F.col("_given").isNull(), "absent")
        .when(same, "unchanged")
        .otherwise("changed")
    )
    both = [c for name in tracked for c in (f"old_{name}", f"new_{name}")]
    return old.join(new, code, "full_outer").select(code, change.alias("change"), *both)


def history(snapshots: DataFrame, code: str, month: str, tracked: list[str]) -> DataFrame:
    """code, tracked columns, valid_from and valid_to: how long each value held, from one row per code and month.

    A value holds from its first month until the month of the next other value, or without end (NULL). Months in which
    a code is not given change nothing; of several rows of a month the first by their values counts.
    """
    once = keep_first(snapshots.select(code, month, *tracked).dropna(subset=[code, month]), [code, month], tracked)
    through = Window.partitionBy(code).orderBy(month)
    value = F.struct(*tracked)
    before = F.lag(value).over(through)
    # The first month has no row before it; a lag that is NULL for another reason cannot occur, a struct is never NULL.
    starts = once.withColumn("_starts", before.isNull() | ~before.eqNullSafe(value)).filter("_starts")
    return starts.select(
        code, *tracked, F.col(month).alias("valid_from"), F.lead(month).over(through).alias("valid_to")
    )


def as_of(rows: DataFrame, intervals: DataFrame, code: str, month: str) -> DataFrame:
    """Rows with the values that held in their month; months before the first value find none and keep NULLs.

    The join is on the code, the interval is its further condition: a code has few intervals, and they do not overlap.
    """
    inside = (F.col(f"f.{month}") >= F.col("h.valid_from")) & (
        F.col("h.valid_to").isNull() | (F.col(f"f.{month}") < F.col("h.valid_to"))
    )
    values = [F.col(f"h.{c}") for c in intervals.columns if c not in (code, "valid_from", "valid_to")]
    joined = rows.alias("f").join(intervals.alias("h"), (F.col(f"f.{code}") == F.col(f"h.{code}")) & inside, "left")
    return joined.select("f.*", *values)


def insert_ignore(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Appends the incoming rows whose key is not there yet; existing rows stay as they are.

    Rows without a key are refused; of several rows with one key the first by their values counts.
    """
    incoming = _one_per_key(incoming, key)
    return existing.unionByName(incoming.join(existing.select(key), key, "left_anti").select(*existing.columns))


def orphans(df: DataFrame, dimension: DataFrame, foreign: str, primary: str) -> DataFrame:
    """Foreign keys with no dimension row, with the number of rows carrying each.

    Keys are counted before the join, so a hot key travels as one row.
    """
    counts = df.groupBy(F.col(foreign).alias("_key")).agg(F.count(F.lit(1)).alias("n_rows"))
    known = dimension.select(F.col(primary).alias("_key"))
    return counts.join(known, "_key", "left_anti").withColumnRenamed("_key", foreign)
