"""Folders of a shared store: names below one, and removal; any store Hadoop can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if there is no such folder."""
    folder, store = _path(spark, path)
    if not store.exists(folder):
        return []
    return [s.getPath().getName() for s in store.listStatus(folder)]


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end."""
    marker, store = _path(spark, f"{path}/_SUCCESS")
    return store.exists(marker)


def remove(spark: SparkSession, path: str) -> None:
    folder, store = _path(spark, path)
    store.delete(folder, True)


def partition_values(spark: SparkSession, path: str, name: str) -> list[str]:
    """Values of the partition folders ``name=value`` directly below a folder."""
    lead = f"{name}="
    return [c[len(lead):] for c in children(spark, path) if c.startswith(lead)]
