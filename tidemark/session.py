"""The session that jobs run in."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "tidemark", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session in UTC with adaptive execution. master is only for runs outside spark-submit."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | (conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
