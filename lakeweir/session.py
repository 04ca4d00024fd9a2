"""Session settings shared by all stages."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.dynamicAllocation.shuffleTracking.enabled": "true",
}


def build(app_name: str, master: str | None = None, **overrides: str) -> SparkSession:
    """A session with the shared settings; ``overrides`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {name.replace("__", "."): value for name, value in overrides.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
