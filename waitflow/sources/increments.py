"""Incremental ingest of a folder of files by their stored state.

Every run lists the folder and compares path, modification time and length with the snapshot of the last run. Files
that are new or changed are read, their rows are stored under the number of the run, and then the run's snapshot is
stored, which says for each listed file in which run it was read. The snapshot is the commit: rows count only as far
as the newest snapshot names their file and run. A run that breaks off before its snapshot leaves nothing visible,
and the next one takes the same number and replaces what was left.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitflow.sources import tables, workspace

RUN = "run"
SNAPSHOT = f"file_path string, location string, modified timestamp, length long, read_in int, {RUN} int"
Reader = Callable[[list[str]], DataFrame]


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Name (as rows carry it), location, modification time and length of the files below a folder, content unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("path").alias("location"),
        F.col("modificationTime").alias("modified"),
        "length",
    )


@dataclass
class Ingest:
    """One folder of files, one stored table of their rows, and the snapshots of its runs."""

    spark: SparkSession
    root: str
    store: str
    read: Reader  # paths -> rows with a file_path column
    pattern: str = "*"

    def _snapshots(self) -> DataFrame:
        return self.spark.read.schema(SNAPSHOT).parquet(f"{self.store}/snapshots")

    def last_run(self) -> int:
        """Number of the newest committed run, 0 before the first."""
        if not workspace.exists(self.spark, f"{self.store}/snapshots"):
            return 0
        return self._snapshots().agg(F.max(RUN)).first()[0] or 0

    def snapshot(self, run: int) -> DataFrame:
        return self._snapshots().filter(F.col(RUN) == run)

    def planned(self, run: int) -> DataFrame:
        """The listing with the run each file is read in: an earlier one where neither time nor length has changed."""
        found = listing(self.spark, self.root, self.pattern)
        if run == 1:
            return found.withColumn("read_in", F.lit(run))
        same = ["file_path", "modified", "length"]
        before = self.snapshot(run - 1).select(*same, "read_in")
        return found.join(before, same, "left").withColumn("read_in", F.coalesce("read_in", F.lit(run)))

    def run(self) -> int:
        """Reads what is new or changed since the last run and commits it; returns the number of files read.

        The paths of the changed files pass through the driver, as every listing of files to read does.
        """
        number = self.last_run() + 1
        plan = self.planned(number).withColumn(RUN, F.lit(number))
        # Written beside the snapshots first: the listing must not change between reading and committing.
        pending = f"{self.store}/pending"
        tables.write_table(plan, pending)
        plan = self.spark.read.schema(SNAPSHOT).parquet(pending)
        paths = sorted(r.location for r in plan.filter(F.col("read_in") == number).select("location").collect())
        rows = f"{self.store}/rows"
        tables.drop_partition(self.spark, rows, RUN, number)
        if paths:
            # All rows go to one partition, so nothing has to be gathered by it first.
            self.read(paths).withColumn(RUN, F.lit(number)).write.mode("append").partitionBy(RUN).parquet(rows)
        tables.drop_partition(self.spark, f"{self.store}/snapshots", RUN, number)
        tables.append_table(plan.coalesce(1), f"{self.store}/snapshots", [RUN])
        return len(paths)

    def rows(self, schema: str) -> DataFrame:
        """Rows of the files in the newest snapshot, as they were when last read."""
        stored = self.spark.read.schema(f"{schema}, file_path string, {RUN} int").parquet(f"{self.store}/rows")
        current = self.snapshot(self.last_run()).select("file_path", F.col("read_in").alias(RUN))
        return stored.join(current, ["file_path", RUN], "left_semi")

    def runs(self) -> DataFrame:
        """Files listed and files read by run."""
        return self._snapshots().groupBy(RUN).agg(
            F.count(F.lit(1)).alias("n_listed"), F.count(F.when(F.col("read_in") == F.col(RUN), 1)).alias("n_read")
        )
