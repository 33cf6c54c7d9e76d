"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "tabwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    ``master`` is left to ``spark-submit`` unless given. Extra keyword pairs override the
    defaults; dots in a key are written as two underscores.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # checkpoints of intermediate tables go when nothing refers to them any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # room for state frames (per-feature reports) to be planned as one projection
        "spark.sql.codegen.maxFields": "400",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
