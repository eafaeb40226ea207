"""Session defaults for the jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(name: str = "tidemark", cores: str = "*", shuffle: int = 8) -> SparkSession:
    """A session for tests and the benchmark; on a cluster the submitter configures Spark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
