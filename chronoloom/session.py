"""A local session with the settings the library expects."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str = "chronoloom", cpus: int | None = None, shuffle: int | None = None,
                  memory: str = "12g") -> SparkSession:
    cpus = cpus or os.cpu_count() or 8
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName(name)
             .config("spark.sql.shuffle.partitions", str(shuffle or cpus))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .config("spark.driver.memory", memory)
             .config("spark.ui.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
