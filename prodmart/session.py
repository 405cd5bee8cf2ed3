"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app_name: str = "prodmart", **conf: object) -> SparkSession:
    """Session with UTC timestamps, AQE and skew-join handling; the cluster's own settings stay as they are."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Epoch columns become UTC wall-clock timestamps whatever zone the session started with."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
