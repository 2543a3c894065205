"""Table and folder scans, and registration of folders in the catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillhouse.plans.periods import Period, within
from tillhouse.sinks import versions


def read_catalog(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Whole table by its catalog name."""
    return spark.table(f"{database}.{table}")


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, period: Period | None = None
) -> DataFrame:
    """Stored table by its root folder, as versions or as plain partition folders; a period
    prunes partitions."""
    if versions.is_versioned(spark, path):
        return versions.read(spark, path, schema, period)
    return within(spark.read.schema(schema).parquet(path), period).select(*schema.names)


def read_partition_folder(
    spark: SparkSession, root: str, folder: str, schema: T.StructType
) -> DataFrame:
    """One partition folder, with the partition columns taken from its path."""
    reader = spark.read.schema(schema).option("basePath", root)
    return reader.parquet(f"{root.rstrip('/')}/{folder.strip('/')}")


def register_folder(
    spark: SparkSession,
    database: str,
    table: str,
    path: str,
    schema: T.StructType,
    partitions: Sequence[str] = (),
    file_format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> str:
    """Make a folder a catalog table (names like ``bronze_pos``, ``gold_sales_mart``)
    and find its partitions. Running it again picks up new partitions. ``options`` are
    those of the format, such as ``{"header": "true"}`` for gold CSV.

    Of a table kept in versions, the partitions point at the version that counts when this
    is called; call it after a change to let readers by name see it."""
    name = f"`{database}`.`{table}`"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    given = ", ".join(f"'{key}' '{value}'" for key, value in (options or {}).items())
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    held = versions.current(spark, path)
    if held:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {file_format}"
        f"{f' OPTIONS ({given})' if given else ''} {by} LOCATION '{path}'"
    )
    if held:
        spark.sql(f"ALTER TABLE {name} ADD " + " ".join(
            f"PARTITION ({_specification(folder)}) LOCATION '{path}/data/version={version}/{folder}'"
            for folder, version in sorted(held.items())
        ))
    elif partitions:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    else:
        spark.sql(f"REFRESH TABLE {name}")
    return name


def _specification(folder: str) -> str:
    levels = [level.split("=", 1) for level in folder.split("/")]
    return ", ".join(f"`{name}` = '{value}'" for name, value in levels)
