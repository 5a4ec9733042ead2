"""Session settings used by the bench and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, name: str = "nestloom") -> SparkSession:
    """Local session; on a cluster the settings come from its own defaults."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # collected lists arrive sorted by their key, so aggregate them in that order
        .config("spark.sql.execution.replaceHashWithSortAgg", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
