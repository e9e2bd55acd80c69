"""Session with the settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Call-site capture costs more than planning for expressions built column by column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local(cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own partition count and memory."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("waitflow")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
