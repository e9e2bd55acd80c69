"""Pathway-level input: one row per patient group, mapped from the order/line tables.

Only the joins a query needs are made. The period comes from the order, so lines and orders always meet;
the specialty is added before grouping because it is part of the grain; provider name and region are
attached after grouping, on far fewer rows. Every dimension joins left-deep as a bare table, so Spark's own
size check (spark.sql.autoBroadcastJoinThreshold, then AQE) picks broadcast or sort-merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waitflow.sources.tables import table

# Fixed values of the mapping: months added to the order month, wait period in days, open status.
MONTH_SHIFT = 291
WAIT_DAYS = 371
OPEN_STATUS, DONE_STATUS, ADMITTED_FLAG = "O", "F", "R"
SPECIALTY_GROUPS = ["Surgical", "Medical", "Mental Health"]


def period_of(order_date: Column) -> Column:
    return F.add_months(F.trunc(order_date, "MM"), MONTH_SHIFT)


def provider_code(provider_id: Column) -> Column:
    """'S' and five digits to the base 36: six characters, as codes have. Ids that need more digits are an error."""
    digits = F.conv(provider_id.cast("string"), 10, 36)
    too_long = F.raise_error(F.concat(F.lit("provider id has no six-character code: "), provider_id.cast("string")))
    return F.when(F.length(digits) > 5, too_long.cast("string")).otherwise(F.concat(F.lit("S"), F.lpad(digits, 5, "0")))


def order_bounds(start: str | None, end: str | None) -> list[Column]:
    """Conditions on the order date that hold for orders of the months from start to end, and reach the scan."""
    at = F.col("o_orderdate")
    found = []
    for month, shift, compare in ((start, -MONTH_SHIFT, at.__ge__), (end, 1 - MONTH_SHIFT, at.__lt__)):
        if month is not None:
            edge = F.add_months(F.trunc(F.lit(month).cast("date"), "MM"), shift)
            found.append(compare(edge.cast("timestamp_ntz")))
    return found


def _brand_number(code: Column) -> Column:
    return F.substring_index(code, "#", -1)


def specialty_name(code: Column) -> Column:
    return F.concat(F.lit("Specialty "), _brand_number(code))


def specialty_group(code: Column) -> Column:
    group = _brand_number(code).try_cast("int") % len(SPECIALTY_GROUPS)
    first, second, third = SPECIALTY_GROUPS
    return F.when(group == 0, first).when(group == 1, second).when(group == 2, third)


def pathways(
    spark: SparkSession,
    directory: str,
    specialty: bool = True,
    start: str | None = None,
    end: str | None = None,
    tables: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """period_date, provider_id, [treatment_function_code,] wait_week, patients, is_open, is_admitted.

    start and end are the first and last month to read; they are turned into bounds of the order date, so that the
    scan of the orders skips what lies outside. Lines and orders can be given, as when they are stored in buckets.
    """
    source = tables or {n: table(spark, directory, n) for n in ("lineitem", "orders")}
    lines = source["lineitem"].select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.col("l_suppkey").alias("provider_id"),
        F.floor("l_quantity").cast("int").alias("patients"),
        (F.col("l_linestatus") == OPEN_STATUS).alias("is_open"),
        (F.col("l_linestatus") == DONE_STATUS).alias("is_done"),
        (F.col("l_returnflag") == ADMITTED_FLAG).alias("is_admitted"),
        F.to_date("l_shipdate").alias("ship_day"),
    )
    lines = lines if specialty else lines.drop("l_partkey")
    if specialty:
        part = table(spark, directory, "part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("treatment_function_code")
        )
        lines = lines.join(part, "l_partkey")
    orders = source["orders"]
    for bound in order_bounds(start, end):
        orders = orders.filter(bound)
    orders = orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("order_day")
    )
    gap = F.pmod(F.datediff("ship_day", "order_day"), F.lit(WAIT_DAYS))
    kept = ["provider_id", "patients", "is_open", "is_done", "is_admitted", "l_orderkey", "l_linenumber"]
    if specialty:
        kept.append("treatment_function_code")
    return lines.join(orders, "l_orderkey").select(
        period_of(F.col("order_day")).alias("period_date"), F.floor(gap / 7).cast("int").alias("wait_week"), *kept
    )


def with_provider(df: DataFrame, spark: SparkSession, directory: str) -> DataFrame:
    """Adds provider code, name and region to a frame that carries provider_id."""
    supplier = table(spark, directory, "supplier").select(
        F.col("s_suppkey").alias("provider_id"), F.col("s_name").alias("provider_org_name"), "s_nationkey"
    )
    nation = table(spark, directory, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("r_regionkey")
    )
    region = table(spark, directory, "region").select(
        "r_regionkey",
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("region_code"),
        F.col("r_name").alias("region_name"),
    )
    return (
        df.join(supplier, "provider_id", "left")
        .join(nation, "s_nationkey", "left")
        .join(region, "r_regionkey", "left")
        .drop("s_nationkey", "r_regionkey")
        .withColumn("provider_org_code", provider_code(F.col("provider_id")))
    )


def with_specialty(df: DataFrame) -> DataFrame:
    code = F.col("treatment_function_code")
    return df.withColumns(
        {"treatment_function_name": specialty_name(code), "specialty_group": specialty_group(code)}
    )
