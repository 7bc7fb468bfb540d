"""A Spark session with the settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "betaloom", master: str | None = None, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """AQE with skew joins, UTC, ANSI. On a cluster leave shuffle_partitions to spark-defaults or about 128 MB each."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
    } | {k.replace("__", "."): str(v) for k, v in conf.items()}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return b.config(map=settings).getOrCreate()
