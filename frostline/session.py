"""Session for tests and the bench; on a cluster the submitter configures Spark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, **conf: str) -> SparkSession:
    cores = cores or os.cpu_count() or 8
    settings = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        # Do not record a Python call site for every column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("frostline")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
