"""Landing of raw feed files into folders of their arrival time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.operators.survivors import keep_newest

DAILY = ("year", "month", "day")
HOURLY = (*DAILY, "hour")

# A scan task of 128 MB, which counts each file as at least 4 MB, never holds
# more files than this; a task that does sorts the rows of the others.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_FILES = 40


def _in_utc(moment: dt.datetime) -> dt.datetime:
    """Wall clock in UTC; a time without zone is taken as UTC already."""
    return moment if moment.tzinfo is None else moment.astimezone(dt.UTC).replace(tzinfo=None)


def with_arrival(rows: DataFrame, arrived_at: dt.datetime, hourly: bool) -> DataFrame:
    """Add the arrival time and its partition columns (UTC)."""
    arrived_at = _in_utc(arrived_at)
    partitions = HOURLY if hourly else DAILY
    # As text, since a datetime literal would pass through the zone of this machine.
    stamped = rows.withColumn("ingest_ts", F.lit(arrived_at.isoformat(sep=" ")).cast("timestamp"))
    return stamped.withColumns({name: F.lit(getattr(arrived_at, name)) for name in partitions})


def file_name() -> Column:
    """Name of the file a row was read from."""
    return F.col("_metadata.file_name")


def land(
    spark: SparkSession, rows: DataFrame, path: str, arrived_at: dt.datetime, hourly: bool
) -> None:
    """Add the rows of source files to the folder of the arrival time.

    ``rows`` carry their file name in ``source_file``, which is the last partition level: a
    file that landed in that hour or day before under the same name is replaced, and no
    other file is touched or read. No rows, no change.

    Each task writes the rows it scans, as they come: a file's rows lie together already, and
    neither a shuffle nor a sort by file name has to hold them.
    """
    arriving = with_arrival(rows, arrived_at, hourly)
    if arriving.isEmpty():
        return
    partitions = [*(HOURLY if hourly else DAILY), "source_file"]
    before = spark.conf.get(WRITERS, None)
    spark.conf.set(WRITERS, str(OPEN_FILES))
    try:
        (
            arriving.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partitions)
            .parquet(path)
        )
    finally:
        spark.conf.unset(WRITERS) if before is None else spark.conf.set(WRITERS, before)


def latest_objects(records: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """Record per object name ``{id}_{timestamp}.json``: the last one to arrive wins,
    as when each record overwrites an object of that name."""
    pieces = [F.coalesce(F.col(k).cast("string"), F.lit("None")) for k in keys]
    named = records.withColumn("object_name", F.concat(F.concat_ws("_", *pieces), F.lit(".json")))
    return keep_newest(named, ["object_name"], arrival)
