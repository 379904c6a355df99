"""Session defaults for running the engine on its own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "larder", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every stage is written for.

    The number of shuffle partitions is left to the cluster's own setting; adaptive
    execution coalesces small ones and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
