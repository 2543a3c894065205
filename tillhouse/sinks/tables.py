"""Partitioned tables: create, replace some partitions, upsert, delete.

Changes are published as versions (``versions``); rows are found by key in an index
(``key_index``) where a changed row may lie in another partition than before.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.operators.merging import merge_frames
from tillhouse.operators.screening import with_complete_key
from tillhouse.operators.survivors import keep_newest
from tillhouse.plans.periods import Period
from tillhouse.plans.silver import SilverTable
from tillhouse.session import working_folder
from tillhouse.sinks import folders, key_index, versions


def write_partitioned(
    df: DataFrame, path: str, partitions: Sequence[str], gather: bool = True
) -> None:
    """Overwrite a folder with one subfolder per partition value.

    ``gather`` brings the rows of a partition together, so that tasks do not each write
    a sliver of every subfolder; AQE merges small partitions into one task and cuts a
    partition that is too large for one. Rows that all go to one subfolder need none.
    """
    rows = df.hint("rebalance", *[F.col(p) for p in partitions]) if gather else df
    rows.write.mode("overwrite").partitionBy(*partitions).parquet(path)


# Fixed value: how Spark spells a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _folder(partitions: Sequence[str]) -> Column:
    """Partition folder below the table root, as Spark spells it for integers and null."""
    levels = [
        F.concat(F.lit(f"{p}="), F.coalesce(F.col(p).cast("string"), F.lit(NULL_PARTITION)))
        for p in partitions
    ]
    return F.concat_ws("/", *levels)


def _listed(df: DataFrame, partitions: Sequence[str]) -> set[str]:
    """Partition folders the rows of a frame belong to.

    These reach the driver as Spark's own file listing does, one entry per folder.
    """
    days = df.select(*partitions).distinct()  # first, so that a name is made per folder, not per row
    return {row.folder for row in days.select(_folder(partitions).alias("folder")).collect()}


def replace_partitions(
    spark: SparkSession,
    path: str,
    content: DataFrame,
    partitions: Sequence[str],
    touched: set[str],
) -> int:
    """Make ``content`` all there is in the ``touched`` partition folders, as a new version,
    whose number is returned."""
    number, staged = versions.stage(spark, path)
    write_partitioned(content, staged, partitions, gather=len(touched) != 1)
    versions.commit(spark, path, number, partitions, touched)
    return number


def _same_columns(found: T.StructType, expected: T.StructType) -> bool:
    return [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in expected]


def _indexes(table: SilverTable) -> dict[str, tuple[str, ...]]:
    """The indexes a table keeps: of its keys if a row may move, and of its owners."""
    kept = {} if table.key_fixes_partition else {key_index.KEYS: table.keys}
    return kept | ({key_index.OWNERS: (table.owner,)} if table.owner else {})


def upsert(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    table: SilverTable,
    unique: bool = False,
    stored: bool = False,
) -> None:
    """Create the table, or update matched and add unmatched rows.

    Updates without a complete key are left out (``silver.keyless`` selects them for
    quarantine). Only partitions that receive an update, or that hold the old version
    of an updated row, are read and rewritten: the index tells which hold one. Errors are
    raised and the table stays.

    The updates are brought to one row per key and stored, as they are read several times.
    A caller who knows that a complete key comes once says ``unique``; one whose updates are
    a projection of stored rows, ``stored``.
    """
    if not _same_columns(updates.schema, table.schema):
        raise ValueError(f"updates for {table.name} have columns {updates.schema.simpleString()}")
    indexes = _indexes(table)
    for kind, columns in indexes.items():
        key_index.catch_up(spark, path, table.schema, columns, kind)
    staged = working_folder(spark, f"updates-{table.name}")
    changes = with_complete_key(updates, table.keys)
    if not unique:
        changes = keep_newest(changes, table.keys, table.time_column)
    if not stored:
        changes.write.parquet(staged)
        changes = spark.read.schema(table.schema).parquet(staged)
    touched = _listed(changes, table.partitions)
    if touched:
        held = set(versions.current(spark, path))
        if key_index.KEYS in indexes and held - touched:
            found = key_index.whereabouts(spark, path, changes, table.schema, table.keys)
            touched |= {row.folder for row in found.select("folder").distinct().collect()}
        merged = changes
        if held & touched:
            affected = versions.read(spark, path, table.schema, only=touched)
            merged = merge_frames(affected, changes, table.keys)
        merged = merged.select(*table.schema.names)
        number = replace_partitions(spark, path, merged, table.partitions, touched)
        placed = changes.withColumn("folder", _folder(table.partitions))
        for kind, columns in indexes.items():
            key_index.append(spark, path, placed, table.schema, columns, number, kind)
    if not stored:
        folders.remove(spark, staged)


def remove_rows(
    spark: SparkSession,
    path: str,
    table: SilverTable,
    retained: Callable[[DataFrame], DataFrame],
    within: set[str] | None = None,
) -> set[str]:
    """Keep of a stored table what ``retained`` keeps; rewrite only partitions that lose rows,
    which are returned.

    ``retained`` may only drop rows. The number of rows per partition before and after
    tells which partitions change; with ``within`` only those folders are opened.
    """
    existing = versions.read(spark, path, table.schema, only=within)

    def sizes(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(_folder(table.partitions).alias("folder")).agg(F.count("*").alias(name))

    before, after = sizes(existing, "before"), sizes(retained(existing), "after")
    shrunk = before.join(after, "folder", "left").where(
        F.coalesce("after", F.lit(0)) < F.col("before")
    )
    touched = {row.folder for row in shrunk.select("folder").collect()}
    if touched:
        affected = versions.read(spark, path, table.schema, only=touched)
        content = retained(affected).select(*table.schema.names)
        number = replace_partitions(spark, path, content, table.partitions, touched)
        # Nothing was added, so the indexes need no entries of this version.
        for kind in _indexes(table):
            key_index.mark(spark, path, number, kind)
    return touched


def purge(
    spark: SparkSession,
    path: str,
    table: SilverTable,
    retained: Callable[[DataFrame], DataFrame],
    oldest: dt.date,
    forgotten: DataFrame,
) -> set[str]:
    """``remove_rows`` that opens only folders of days before ``oldest``, told by their names,
    and folders that the index of owners gives for the ``forgotten``."""
    key_index.catch_up(spark, path, table.schema, (table.owner,), key_index.OWNERS)
    held = versions.current(spark, path)
    opened = {folder for folder in held if Period.may_begin_before(folder, oldest)}
    opened |= key_index.folders_of(spark, path, forgotten, table.schema, table.owner) & set(held)
    return remove_rows(spark, path, table, retained, opened) if opened else set()
