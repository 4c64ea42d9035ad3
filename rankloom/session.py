"""Spark session defaults for the jobs of this package."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def spark_session(app: str = "rankloom", master: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution on. Extra settings use ``__`` for the dot.

    On a cluster leave ``master`` out and set ``spark.checkpoint.dir`` to a shared folder:
    intermediate tables are written there.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()
