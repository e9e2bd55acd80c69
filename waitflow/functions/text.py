"""Text parsing: reporting periods, codes and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waitflow import schemas as S


def parse_period(text: Column) -> Column:
    """First of the month from 'April 2019' or '2019-04-01'; NULL for anything else."""
    clean = F.trim(text)
    named = F.try_to_date(F.when(clean.rlike("^[A-Za-z]+ [0-9]{4}$"), clean), "MMMM yyyy")
    return F.trunc(F.coalesce(named, clean.try_cast("date")), "MM")


def is_code(code: Column) -> Column:
    return code.rlike(S.CODE_PATTERN)


def first_keyword(text: Column, keywords: list[tuple[str, str]]) -> Column:
    """Label of the first keyword contained in the text, ignoring case; NULL when none is."""
    lowered = F.lower(text)
    hits = [F.when(lowered.contains(k.lower()), F.lit(label)) for k, label in keywords]
    return F.coalesce(*hits)


def file_kind(name: Column) -> Column:
    return first_keyword(name, S.FILE_KINDS)


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)
