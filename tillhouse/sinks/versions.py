"""Versions of a partitioned table.

A change writes the new content of the partitions it touches below ``data/version=N`` and
then names, below ``current/version=N``, which version of each partition counts. That second
write is the commit: Spark marks it with ``_SUCCESS`` when it is whole. Nothing is renamed
or overwritten, a change that dies before its commit is never seen, and readers that began
before a commit go on reading the folders they were given. Folders that no kept version
names are removed later (``remove_old``). A table has one writer at a time.

The list of current folders passes through the driver, one entry per partition, as the
partitions of a catalog table do.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.plans.periods import Period, within
from tillhouse.sinks import folders


def latest(spark: SparkSession, path: str) -> int:
    """Number of the version that counts; 0 where nothing was ever committed."""
    return max(folders.finished_versions(spark, f"{path}/current"), default=0)


def is_versioned(spark: SparkSession, path: str) -> bool:
    return latest(spark, path) > 0


def current(spark: SparkSession, path: str, version: int | None = None) -> dict[str, int]:
    """Partition folders of a version, and the version that holds the content of each."""
    number = latest(spark, path) if version is None else version
    if not number:
        return {}
    schema = "folder string, version bigint"
    rows = spark.read.schema(schema).parquet(f"{path}/current/version={number}").collect()
    return {row.folder: row.version for row in rows}


def read(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    period: Period | None = None,
    only: Collection[str] | None = None,
) -> DataFrame:
    """The current rows: all of them, those of a period, or those of some partition folders.
    Other folders are not even listed."""
    rows = read_placed(spark, path, schema, period, only)
    return within(rows, period).select(*schema.names)


def read_placed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    period: Period | None = None,
    only: Collection[str] | None = None,
) -> DataFrame:
    """Like ``read``, as the files' own frame, which also tells of the files."""
    held = current(spark, path)
    chosen = [
        f"{path}/data/version={version}/{folder}"
        for folder, version in sorted(held.items())
        if (only is None or folder in only) and (period is None or period.holds(folder))
    ]
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*chosen)


def stage(spark: SparkSession, path: str) -> tuple[int, str]:
    """Number of the next version and the folder its content goes to. What an attempt that
    died has left there is overwritten."""
    number = latest(spark, path) + 1
    return number, f"{path}/data/version={number}"


def commit(
    spark: SparkSession, path: str, number: int, partitions: Sequence[str], touched: Collection[str]
) -> None:
    """Let staged content count: of the ``touched`` folders, and those that it fills, only
    what the new version holds remains."""
    filled = folders.partition_folders(spark, f"{path}/data/version={number}", partitions)
    held = {f: v for f, v in current(spark, path, number - 1).items() if f not in touched}
    held |= dict.fromkeys(filled, number)
    listing = spark.createDataFrame(sorted(held.items()), "folder string, version bigint")
    listing.coalesce(1).write.mode("overwrite").parquet(f"{path}/current/version={number}")


def remove_old(spark: SparkSession, path: str, partitions: Sequence[str], keep: int = 2) -> None:
    """Remove content that none of the last ``keep`` versions names, and the older lists."""
    finished = sorted(folders.finished_versions(spark, f"{path}/current"))
    kept, old = finished[-keep:], finished[:-keep]
    if not old:
        return
    named: set[tuple[str, int]] = set()
    for version in kept:
        named |= set(current(spark, path, version).items())
    for version in range(1, kept[-1] + 1):
        folder = f"{path}/data/version={version}"
        held = folders.partition_folders(spark, folder, partitions)
        stale = [f for f in held if (f, version) not in named]
        for name in [folder] if len(stale) == len(held) else [f"{folder}/{f}" for f in stale]:
            folders.remove(spark, name)
    for version in old:
        folders.remove(spark, f"{path}/current/version={version}")


def placed_in(rows: DataFrame, folder: str = "folder") -> DataFrame:
    """Rows of a version's data with the partition folder they lie in, read off the path."""
    name = F.regexp_extract("_metadata.file_path", r"/version=\d+/(.*)/[^/]*$", 1)
    return rows.withColumn(folder, name)
