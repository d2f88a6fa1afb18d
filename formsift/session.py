"""Session for local runs and tests; on a cluster the caller's session is used as it is."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: str = "*", app: str = "formsift", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("FORMSIFT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.files.minPartitionNum", cores if cores.isdigit() else str(os.cpu_count() or 1))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
