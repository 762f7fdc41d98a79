"""Intermediate tables in the cluster's shared folder.

A record is parsed and checked once. Everything after that reads a column-pruned table written
next to the checkpoints, so neither a lost executor nor a second use parses the text again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it, else the warehouse."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def staging_root(spark: SparkSession) -> str:
    """Where this application keeps its staged tables."""
    return f"{shared_dir(spark)}/evpipe/staged/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever store it lies; nothing happens when there is none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _store(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, store = _store(spark, path)
    return store.exists(folder)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, none when there is no such folder."""
    folder, store = _store(spark, path)
    if not store.exists(folder):
        return []
    return [status.getPath().getName() for status in store.listStatus(folder)]


def make_folder(spark: SparkSession, path: str) -> None:
    folder, store = _store(spark, path)
    store.mkdirs(folder)


def publish(spark: SparkSession, written: str, path: str) -> None:
    """Move a finished folder to where readers look, in place of what lies there.

    One rename, so readers see all of it or nothing wherever the store renames folders at once.
    """
    remove_path(spark, path)
    folder, store = _store(spark, path)
    store.mkdirs(folder.getParent())
    if not store.rename(_store(spark, written)[0], folder):
        raise OSError(f"{written} could not be moved to {path}")


def remove_staged(spark: SparkSession) -> None:
    """Remove what this application has staged, at the end of a run."""
    remove_path(spark, staging_root(spark))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` and return the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

