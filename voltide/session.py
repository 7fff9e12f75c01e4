"""Session for local runs (tests, bench). On a cluster the caller brings its own session."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(app: str = "voltide", cores: int | str | None = None) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS") or 8
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("VOLTIDE_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", os.environ.get("VOLTIDE_SHARED_DIR") or tempfile.mkdtemp(prefix="voltide-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
