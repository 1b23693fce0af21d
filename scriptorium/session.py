"""Session builder: UTC, adaptive execution, Arrow."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(app: str = "scriptorium", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
