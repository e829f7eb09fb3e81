"""SparkSession factory with the settings the operators are tested under."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "weftline", cores: int | None = None, **conf: str) -> SparkSession:
    """Local session: UTC, AQE on, shuffle partitions sized to the cores.

    On a cluster the caller's own session is used instead; no operator depends on these values.
    """
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    settings = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): str(v) for k, v in conf.items()}
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
