"""Contiguous, byte-balanced shards from global prefix sums, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waitflow.llm.store import stored

SHARDS = 8


def cut_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Law `bytes`: rows in doc_id order, cut where the running size passes each equal share.

    The size of a row is its UTF-8 bytes plus 1 (a NULL text has none). Rows are dealt into ranges of doc_id;
    each range is summed and counted (combined before the shuffle), the few range totals give every range its
    start, and rows are only ordered inside their range. A row belongs to the shard in which its middle byte
    falls, so shards are contiguous and differ from the equal share by less than one row. Slots count rows from
    0 inside a shard.

    Equal doc_ids are ordered by checksum and size; a NULL doc_id comes first; an empty table gives no rows; a
    row larger than a share may leave a shard empty. Other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    slim = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    order = [F.asc_nulls_first("doc_id"), F.asc("text_crc32"), F.asc("size")]
    # Written once, so that a lost executor cannot deal the ranges anew between the two readers.
    dealt = stored(slim.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy("part").agg(F.sum("size").alias("part_size"), F.count(F.lit(1)).alias("part_rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    everything = Window.partitionBy()
    starts = totals.select(
        "part",
        F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("part_size").over(everything).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        dealt.withColumns({"_upto": F.sum("size").over(inside), "_nth": F.row_number().over(Window.partitionBy("part").orderBy(*order))})
        .join(starts, "part")
        .withColumns(
            {
                "_double_middle": 2 * (F.col("size_before") + F.col("_upto")) - F.col("size"),
                "_row": F.col("rows_before") + F.col("_nth") - 1,
            }
        )
        .withColumn("shard", F.least(F.expr(f"_double_middle * {shards} DIV (2 * total)"), F.lit(shards - 1)).cast("int"))
    )
    # First row of each range in each shard: a few rows per range, then one per shard.
    firsts = stored(placed.select("doc_id", "size", "text_crc32", "shard", "_row"), "placed")
    base = firsts.groupBy("shard").agg(F.min("_row").alias("_first"))
    return firsts.join(F.broadcast(base), "shard").select(  # one row per shard
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_row") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
