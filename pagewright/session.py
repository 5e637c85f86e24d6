"""The Spark session that tests, bench and command line share."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g", name: str = "pagewright") -> SparkSession:
    """A local session: UTC, adaptive execution and Arrow on, no web page."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", os.environ.get("PAGEWRIGHT_DRIVER_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
