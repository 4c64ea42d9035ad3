"""Intermediate tables in the shared checkpoint folder.

A written table cuts the lineage, survives the loss of any executor, can be read column by
column, and gives the optimizer its true size.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; in local mode one in the warehouse if unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/rankloom-scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one table; never reused, so a retried job cannot mix with an old one."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark).rstrip('/')}/{app}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and continue from the written table."""
    return _written(df, scratch_path(df.sparkSession, name))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, in whatever store it lies."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Tables that a job needs only while it runs: they are deleted when the block ends, also by an error.

    What the job returns must not read them any more.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error: object) -> None:
        for path in self._paths:
            delete_folder(self._spark, path)

    def path(self, name: str) -> str:
        self._paths.append(scratch_path(self._spark, name))
        return self._paths[-1]

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """As :func:`materialize`."""
        return _written(df, self.path(name))


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Run jobs that do not depend on each other at the same time, so that one fills the cores the other leaves idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]
