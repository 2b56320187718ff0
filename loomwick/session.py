"""The session settings the engine is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "loomwick", **settings: str) -> SparkSession:
    """UTC, adaptive execution with skew handling; anything else by keyword (dots as double underscores)."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
