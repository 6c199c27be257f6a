"""A Spark session for local runs; on a cluster the caller brings its own."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(app: str = "webloom", cpus: int | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="webloom-"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
