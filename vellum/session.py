"""Session defaults and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own session."""
    checkpoints = os.path.join(tempfile.gettempdir(), "checkpoints")
    builder = SparkSession.builder.master(f"local[{cores}]").appName("vellum")
    settings = DEFAULTS | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": memory,
        "spark.checkpoint.dir": f"file://{checkpoints}",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
