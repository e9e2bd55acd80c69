"""Download links on crawled pages and the manifest of what is still to fetch (nothing is fetched here)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.functions.text import first_keyword, last_segment

HREF = "<a\\s[^>]*?href=[\"']([^\"']*)[\"']"


def has_extension(href: Column, extensions: list[str]) -> Column:
    lowered = F.lower(href)
    found = F.lit(False)
    for e in extensions:
        found = found | lowered.endswith(e)
    return found


def classified_links(
    pages: DataFrame,
    site: str,
    keywords: list[tuple[str, str]] = S.FILE_KINDS,
    extensions: list[str] = S.SHEET_EXTENSIONS,
    carried: Sequence[Column] = (),
) -> DataFrame:
    """page_id, position, filename, full_url, file_type of every link with a known extension and keyword.

    carried: named expressions over the page that its links keep, so that nothing joins back to the pages.
    """
    kept = pages.select(*carried).columns
    found = pages.select(
        "page_id", *carried, F.posexplode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("position", "href")
    )
    href = F.col("href")
    full = F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(site), href))
    return (
        found.filter(has_extension(href, extensions))
        .select(
            "page_id",
            "position",
            last_segment(href).alias("filename"),
            full.alias("full_url"),
            first_keyword(href, keywords).alias("file_type"),
            *kept,
        )
        .filter("file_type IS NOT NULL")
    )


def new_files(links: DataFrame, ingested: DataFrame, group: str) -> DataFrame:
    """Files linked from a group's pages that have not been ingested for that group."""
    files = links.groupBy(group, "file_type", "filename").agg(F.count(F.lit(1)).alias("n_links"))
    return files.join(ingested, [group, "filename"], "left_anti")


def linked_files(links: DataFrame, group: str, there: str) -> DataFrame:
    """group, file_type, filename, n_links, known; a file is known (else NULL) where any of its group's links is there."""
    files = links.groupBy(group, "file_type", "filename").agg(
        F.count(F.lit(1)).alias("n_links"), F.max(F.when(F.col(there), True)).alias("known")
    )
    return files.withColumn("known", F.max("known").over(Window.partitionBy(group, "filename")))


def count_new(files: DataFrame, group: str) -> DataFrame:
    """Links per group and type: how many lead to a new file, how many are skipped.

    A file counts as new once per group; later links to it, and links to known files, are skipped.
    """
    return (
        files.groupBy(group, "file_type")
        .agg(F.sum("n_links").alias("n_links"), F.count(F.when(F.col("known").isNull(), True)).alias("n_new"))
        .withColumn("n_skipped", F.col("n_links") - F.col("n_new"))
    )


def manifest(links: DataFrame, ingested: DataFrame, group: str) -> DataFrame:
    """count_new against a table of ingested files."""
    known = ingested.select(group, "filename").distinct().withColumn("known", F.lit(True))
    files = links.groupBy(group, "file_type", "filename").agg(F.count(F.lit(1)).alias("n_links"))
    return count_new(files.join(known, [group, "filename"], "left"), group)
