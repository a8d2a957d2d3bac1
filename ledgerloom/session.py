"""A session with the settings that the library's results rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI casts (bad text raises unless a function says otherwise), adaptive execution."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
