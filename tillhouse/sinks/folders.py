"""Folder questions, asked through the Hadoop file system of the path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _locate(spark, path)
    return file_system.exists(hadoop_path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """A Spark job finished writing this folder."""
    return exists(spark, f"{path}/_SUCCESS")


def mark_complete(spark: SparkSession, path: str) -> None:
    """Leave the mark of a finished job in a folder, which is made if it is not there."""
    file_system, _ = _locate(spark, path)
    file_system.create(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"), True).close()


def partition_folders(spark: SparkSession, path: str, partitions: Sequence[str]) -> set[str]:
    """Partition folders below a table root, relative to it (``year=2024/month=5``)."""
    file_system, root = _locate(spark, path)
    pattern = "/".join(f"{name}=*" for name in partitions)
    found = file_system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, pattern)) or []
    return {"/".join(f.getPath().toString().split("/")[-len(partitions):]) for f in found}


def remove(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _locate(spark, path)
    file_system.delete(hadoop_path, True)


def finished_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the folders ``version=N`` below a path that a Spark job finished."""
    file_system, root = _locate(spark, path)
    found = file_system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "version=*/_SUCCESS"))
    return [int(f.getPath().getParent().getName().split("=")[1]) for f in found or []]
