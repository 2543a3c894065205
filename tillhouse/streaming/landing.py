"""Live records into the bronze layer.

Streams end in file sinks, which record finished batches in the checkpoint and in the
sink's own log, so a restarted query neither loses nor repeats a batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillhouse.sources.envelopes import carries

HOURLY = ("year", "month", "day", "hour")
EVERY_MINUTE = {"processingTime": "60 seconds"}
UNTIL_CAUGHT_UP = {"availableNow": True}


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "json",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Files of a folder as they arrive. The path may be a glob."""
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def with_batch_time(stream: DataFrame) -> DataFrame:
    """Name the micro-batch of each row: the clock of a batch stands still, so its
    start time is the same for all its rows and differs from every other batch."""
    return stream.withColumn("batch_time", F.current_timestamp())


def screen(stream: DataFrame, required: Sequence[str], column: str = "value") -> DataFrame:
    """Mark records (JSON text) that carry all required fields as ``accepted``."""
    return stream.withColumn("accepted", F.coalesce(carries(F.col(column), required), F.lit(False)))


OUTCOME_HOURLY = ("outcome", *HOURLY)


def with_outcome(stream: DataFrame, required: Sequence[str], column: str = "value") -> DataFrame:
    """Say what becomes of each record: ``accepted``, ``bad_json`` or ``missing_field``.
    As the first partition column it lands accepted and refused records, these by kind of
    error and hour, in one pass."""
    complete = carries(F.col(column), required)
    outcome = (
        F.when(complete.isNull(), "bad_json").when(~complete, "missing_field").otherwise("accepted")
    )
    return stream.withColumn("outcome", outcome)


def with_lane(stream: DataFrame, lanes: int, key: str = "partition_key") -> DataFrame:
    """Number of the ordered lane that all records of one key go to, as a partition column.

    A lane is read in the order of arrival: batches one after the other, and within a batch
    by the position of the record, which the reader sorts by. Records without a key share
    lane 0. The lane is the digest of the key, so it does not change with the cluster."""
    digest = F.conv(F.substring(F.md5(F.col(key).cast("binary")), 1, 7), 16, 10).cast("bigint")
    return stream.withColumn("lane", F.coalesce(digest % lanes, F.lit(0)).cast("int"))


def with_arrival_hour(stream: DataFrame, arrival: Column | None = None) -> DataFrame:
    """Partition columns of the arrival time, by default the start of the batch."""
    at = F.current_timestamp() if arrival is None else arrival
    return stream.withColumns(
        {"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at), "hour": F.hour(at)}
    )


def with_partition_key(stream: DataFrame, field: str, column: str = "value") -> DataFrame:
    """Field of the record that a stream is divided by (customer or session).

    Kept as a column only. Order within a key is that of the event time, so the rows of
    one key need not travel through one task.
    """
    return stream.withColumn("partition_key", F.get_json_object(column, f"$.{field}"))


def start_landing(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    file_format: str = "json",
    partitions: Sequence[str] = HOURLY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append a stream to hourly folders of gzip JSON (or parquet) files."""
    writer = (
        stream.writeStream.outputMode("append")
        .format(file_format)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**(trigger or EVERY_MINUTE))
    )
    if file_format == "json":
        writer = writer.option("compression", "gzip").option("ignoreNullFields", False)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.start()


def run_until_caught_up(
    stream: DataFrame, path: str, checkpoint: str, **options
) -> StreamingQuery:
    """Process what is there, in as many batches as the source asks for, and stop."""
    query = start_landing(stream, path, checkpoint, trigger=UNTIL_CAUGHT_UP, **options)
    query.awaitTermination()
    return query


def final_watermark(query: StreamingQuery) -> str | None:
    """Watermark of a stopped query, as ISO text in UTC; none if no event had a time."""
    seen = [p["eventTime"].get("watermark") for p in query.recentProgress if p.get("eventTime")]
    return seen[-1] if seen else None
