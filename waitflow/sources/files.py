"""CSV sources and sinks with fixed schemas."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitflow import schemas as S
from waitflow.functions.text import file_kind
from waitflow.sources.sheets import cells_of


def read_processed(spark: SparkSession, path: str | list[str], schema: T.StructType, as_text: bool = False) -> DataFrame:
    """Processed CSV with a header, columns checked by name; `as_text` reads every column as a string."""
    return (
        spark.read.schema(S.as_text(schema) if as_text else schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(path)
    )


def write_processed(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; a quote inside of a quoted cell is doubled."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


RECORD = "_record"


def scan_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool = False, pattern: str = "*.csv"
) -> DataFrame:
    """Every CSV file below a folder, columns typed by the schema, with the path each row comes from.

    A record that does not fit (a cell too few or too many, or one that is no number) keeps its text in `_record`.
    All columns are parsed for that, whatever a query reads, so a record is judged alike by every query. multi_line
    is for cells that hold line feeds: a file is then read by one task, else large files are split.
    """
    fields = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    rows = (
        spark.read.schema(fields)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RECORD)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .csv(path)
    )
    # Spark judges a record by the columns that a query reads, and refuses a scan of the record alone. This holds for
    # every row and keeps all columns in the scan.
    n_null = reduce(add, [F.col(f"`{n}`").isNull().cast("int") for n in schema.fieldNames()])
    return rows.filter(n_null >= 0).select("*", F.col("_metadata.file_path").alias("file_path"))


def fitting(scanned: DataFrame) -> DataFrame:
    return scanned.filter(F.col(RECORD).isNull()).drop(RECORD)


def rejected(scanned: DataFrame, schema: T.StructType) -> DataFrame:
    """file_path, record and reason of the records that do not fit: too few cells, too many, or the first unreadable one."""
    names = schema.fieldNames()
    cells = cells_of(F.col(RECORD))
    unread = [
        F.when(F.col(f"`{n}`").isNull() & (F.get(cells, F.lit(i)) != ""), F.lit(f"unreadable {n}")) for i, n in enumerate(names)
    ]
    reason = F.when(F.size(cells) < len(names), "cells missing").when(F.size(cells) > len(names), "cells over")
    found = scanned.filter(F.col(RECORD).isNotNull())
    return found.select("file_path", F.col(RECORD).alias("record"), F.coalesce(reason, *unread, F.lit("unreadable")).alias("reason"))


def write_lines(lines: DataFrame, path: str, header: str | None = None, extension: str = "csv") -> None:
    """Text files from (file, position, line): the lines of a file lie together and in order, below a header if
    there is one, in a folder of its name.

    A file is put together by one task; what is a file at the source has a bounded length. The header goes in front of
    the first line where the file is put together, so the lines are computed once.
    """
    gathered = lines.repartition("file")
    if header is None:
        ordered = gathered.sortWithinPartitions("file", "position").select("file", "line")
    else:
        first = F.row_number().over(Window.partitionBy("file").orderBy("position")) == 1
        given = F.when(first, F.array(F.lit(header), F.col("line"))).otherwise(F.array("line"))
        ordered = gathered.select("file", given.alias("given")).select("file", F.explode("given").alias("line"))
    writer = ordered.write.mode("append").partitionBy("file")
    writer.option("fileExtension", extension).text(path)


def file_of(path: Column) -> Column:
    """The name that write_lines() was given, from the path of a row."""
    return F.regexp_extract(path, "/file=([^/]+)/", 1)


def read_sheets(spark: SparkSession, root: str, kind: str, extension: str = "csv") -> DataFrame:
    """Whole text of every sheet export of one kind under a folder: file_path, file_name, content.

    A sheet is the unit of work: its length is bounded by the spreadsheet format. The file name decides the
    kind, first keyword wins, so NonAdmitted files are not read as Admitted ones.
    """
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*-Provider*.{extension}")
        .text(root, wholetext=True)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("value").alias("content"),
        )
    )
    return files.filter(file_kind(F.col("file_name")) == kind)
