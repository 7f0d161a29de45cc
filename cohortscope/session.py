"""Session settings shared by tests, the bench and batch jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(name: str, cores: str = "8", memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Classes named without the stage number can be reused when a query runs again.
        .config("spark.sql.codegen.useIdInClassName", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark

