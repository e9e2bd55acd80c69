"""Sheet exports with a preamble: the period in row 4, the header in row 13, data below."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.functions.text import parse_period

# One CSV field, quoted or plain, up to the next comma or the end of the line.
_FIELD = '("[^"]*+(?:""[^"]*+)*+"|[^,]*+)(?:,|$)'


# One record of a sheet, up to the next line feed outside of quotes or the end of the text.
_RECORD = '((?:[^"\n]++|"[^"]*+"|")*+)(?:\n|$)'


def unquoted(cell: Column) -> Column:
    inner = F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
    return F.when(cell.startswith('"'), inner).otherwise(cell)


def cells_of(line: Column) -> Column:
    """Fields of one CSV line. Lines without a quote, nearly all of them, are simply split."""
    quoted = F.transform(F.regexp_extract_all(line, F.lit(_FIELD), F.lit(1)), unquoted)
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, ","))


def _with_lines(sheets: DataFrame) -> DataFrame:
    """Records of a sheet. Only a text that has a quote open at the end of a line is not simply split.

    The records are given by a generator, through which no filter is pushed down: as a plain column the split would be
    repeated for each place where a filter over it (of a status, of a period) reads a line.
    """
    content = F.col("content")
    text = F.when(content.contains("\r"), F.regexp_replace(content, "\r", "")).otherwise(content)
    quotes = lambda line: F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    is_open = lambda line: line.contains('"') & (quotes(line) % 2 == 1)
    quoted = F.regexp_extract_all(text, F.lit(_RECORD), F.lit(1))
    # The split text has a name inside of the lambda: it is looked through and taken, but made only once.
    records = F.transform(
        F.array(F.split(text, "\n")),
        lambda lines: F.when(text.contains('"') & F.exists(lines, is_open), quoted).otherwise(lines),
    )
    return sheets.select("*", F.explode(F.array(F.get(records, F.lit(0)))).alias("lines"))


def _line(number: int) -> Column:
    return F.coalesce(F.get("lines", F.lit(number)), F.lit(""))


def _period() -> Column:
    return parse_period(F.get(cells_of(_line(S.PERIOD_ROW)), F.lit(S.PERIOD_COLUMN)))


def sheet_rows(sheets: DataFrame, headings: list[str]) -> DataFrame:
    """Data lines of every sheet with the named headings as text columns (NULL where a file lacks one),
    plus period_date, source_file and row_idx.

    Each file's own header says where a heading is, so column order may differ between files. The places
    are looked up once per file, before its lines are exploded; each data line is split once.
    """
    wanted = F.array(*[F.lit(h) for h in headings])
    # The usual header is known by its text: neither its quoted fields are read nor the headings looked up.
    usual = ",".join('"' + h.replace('"', '""') + '"' for h in headings)
    trimmed = [h.strip(" ") for h in headings]
    in_order = F.array(*[F.lit(trimmed.index(h) if h in trimmed else -1) for h in headings])
    read = F.transform(cells_of(_line(S.HEADER_ROW)), lambda c: F.trim(c))
    looked_up = F.transform(wanted, lambda h: F.array_position(read, h).cast("int") - 1)
    # A generator here as well, or each use of the period would read its line again.
    dated = _with_lines(sheets).select("file_name", "lines", F.explode(F.array(_period())).alias("period"))
    first = S.HEADER_ROW + 1
    body = F.slice("lines", F.lit(first + 1), F.greatest(F.size("lines") - first, F.lit(0)))
    placed = dated.select(
        F.coalesce(F.date_format("period", "yyyy-MM-dd"), F.lit("Unknown")).alias("period_date"),
        F.col("file_name").alias("source_file"),
        F.when(_line(S.HEADER_ROW) == usual, in_order).otherwise(looked_up).alias("places"),
        body.alias("body"),
    ).select("period_date", "source_file", "places", F.posexplode("body").alias("idx", "line"))
    data = placed.filter(F.col("line").rlike("[^, ]")).withColumn("row_idx", F.col("idx") + first)
    # A generator again, so that a filter over the columns splits no line a second time.
    split_up = data.select("places", F.explode(F.array(cells_of(F.col("line")))).alias("cells"), "period_date", "source_file", "row_idx")
    named = [F.expr(f"get(cells, places[{i}]) AS `{h}`") for i, h in enumerate(headings)]
    return split_up.select(*named, "period_date", "source_file", "row_idx")


def file_status(sheets: DataFrame) -> DataFrame:
    """One row per file: readable, or the reason for setting it aside."""
    body = F.filter("lines", lambda x, i: (i > S.HEADER_ROW) & x.rlike("[^, ]"))
    reason = (
        F.when(~_line(S.HEADER_ROW).contains("Provider Code"), "no header")
        .when(_period().isNull(), "no period")
        .when(F.size(body) < 1, "no rows")
        .otherwise("ok")
    )
    return _with_lines(sheets).select("file_name", reason.alias("status"))
