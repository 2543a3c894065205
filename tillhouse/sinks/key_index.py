"""Where the rows of a table lie, by key or by owner.

The index is a table bucketed by the key: (key, partition folder, version of the change).
A change appends one entry per changed row, and the newest entry of a key tells its folder.
Looking up the keys of an update moves only the update to the buckets; the index is read
where it lies. Entries of deleted rows stay and cost a look into one folder; ``rebuild``
writes the index anew from the keys of the table.

A second index of the same form, ``owners``, holds the folders of each owner of rows (a
customer, a user): a deletion or a look into an owner's past opens only these.

Entries are appended after the commit of a change. ``catch_up`` appends those of a version
whose writer died between the two, from the content of that version.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.sinks import folders, versions

#: Buckets of a new index. Choose them so that a bucket of all keys is some 100 MB.
BUCKETS = 16

KEYS, OWNERS = "keys", "owners"


def table_of(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
    kind: str = KEYS, buckets: int = BUCKETS,
) -> str:
    """Catalog name of the index of a table, which is registered if the catalog lost it."""
    name = f"{kind}_index_{hashlib.md5(path.encode()).hexdigest()}"
    columns = ", ".join(f"`{k}` {schema[k].dataType.simpleString()}" for k in keys)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, folder STRING, version BIGINT) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}/index/{kind}/entries'"
    )
    return name


def append(
    spark: SparkSession, path: str, entries: DataFrame, schema: T.StructType,
    keys: Sequence[str], version: int, kind: str = KEYS, anew: bool = False,
) -> None:
    """Entries of the rows of a change (``folder`` and the keys), then the mark that the
    version is indexed. Done again, it adds equal entries, which tell the same."""
    name = table_of(spark, path, schema, keys, kind)
    buckets = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
    rows = entries.select(*keys, "folder", F.lit(version).cast("bigint").alias("version"))
    if kind == OWNERS:  # a key has one row, an owner many
        rows = rows.na.drop(subset=list(keys)).distinct()
    rows.repartition(int(buckets["data_type"]), *keys).write.insertInto(name, overwrite=anew)
    mark(spark, path, version, kind)


def mark(spark: SparkSession, path: str, version: int, kind: str = KEYS) -> None:
    """Note that an index holds what it has to hold of a version."""
    folders.mark_complete(spark, f"{path}/index/{kind}/done/version={version}")


def is_indexed(spark: SparkSession, path: str, version: int, kind: str = KEYS) -> bool:
    return folders.is_complete(spark, f"{path}/index/{kind}/done/version={version}")


def catch_up(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], kind: str = KEYS
) -> None:
    """Index the newest version if its writer did not come to it."""
    version = versions.latest(spark, path)
    if not version or is_indexed(spark, path, version, kind):
        return
    folder = f"{path}/data/version={version}"
    content = spark.read.schema(schema).option("basePath", folder).parquet(folder)
    append(spark, path, versions.placed_in(content), schema, keys, version, kind)


def rebuild(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], kind: str = KEYS
) -> None:
    """Write the index anew: one entry per row of the table."""
    rows = versions.placed_in(versions.read_placed(spark, path, schema))
    append(spark, path, rows, schema, keys, versions.latest(spark, path), kind, anew=True)


def whereabouts(spark: SparkSession, path: str, wanted: DataFrame, schema: T.StructType,
                keys: Sequence[str]) -> DataFrame:
    """Keys of ``wanted`` that the table holds, with their partition folder."""
    entries = spark.table(table_of(spark, path, schema, keys))
    return (
        entries.join(wanted.select(*keys), list(keys), "left_semi")
        .groupBy(*keys)
        .agg(F.max_by("folder", "version").alias("folder"))
    )


def folders_of(spark: SparkSession, path: str, wanted: DataFrame, schema: T.StructType,
               owner: str) -> set[str]:
    """Partition folders that hold, or once held, rows of the ``wanted`` owners."""
    entries = spark.table(table_of(spark, path, schema, (owner,), OWNERS))
    found = entries.join(wanted.select(owner), owner, "left_semi").select("folder").distinct()
    return {row.folder for row in found.collect()}
