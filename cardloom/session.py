"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# On a cluster these belong in spark-defaults; `builder` applies them for
# tests and the benchmark. Shuffle partitions are left to the caller because
# they depend on the data size (aim at 128-256 MB per shuffle partition).
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when the result must be shuffled again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def builder(app: str = "cardloom") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def local_session(cpus: int = 8, partitions: int | None = None) -> SparkSession:
    spark = (
        builder()
        .master(f"local[{cpus}]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
