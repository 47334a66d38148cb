"""Session settings this library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(name: str = "ebbline", master: str | None = None, **settings: str) -> SparkSession:
    """A session with UTC time, adaptive execution and skew handling.

    Shuffle partitions are left to the cluster: adaptive execution coalesces small ones, and a 100 TB
    input needs a value chosen for that cluster.  Extra settings use ``__`` for dots.
    """
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
