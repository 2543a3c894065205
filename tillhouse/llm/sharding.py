"""Shards of shuffled records, by a two-pass external shuffle.

First pass: every record goes to a bucket of its shard by seeded hashes, so that buckets
are uniform parts of the input that fit in the memory of a task. Second pass: each bucket
is put into a random order by a seeded Fisher-Yates shuffle and written. Spark's shuffle
files are the external buckets of the first pass.

The shard follows the law ``key``: the doc_id and the number of shards decide. Each shard
has a seeded hash for the id and the highest wins, so one more shard takes rows only into
itself. Within a shard the bucket also depends on the record's place in the input, so the
rows of one id, or copies of one text, share a shard at most, never a bucket by force.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.session import working_folder

SHARDS = 40
SEED = 20_240_131
BUCKET_BYTES = 16 * 1024 * 1024


def shard_of(doc_id: Column, shards: int, seed: int = SEED) -> Column:
    """The shard whose hash for the id is highest; null ids are a key like any other."""
    draws = [
        F.struct(F.xxhash64(doc_id, F.lit(seed), F.lit(shard)).alias("draw"),
                 F.lit(shard).alias("shard"))
        for shard in range(shards)
    ]
    return F.array_max(F.array(*draws))["shard"] if draws else F.lit(None).cast("int")


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text, none for null, and 16 for the rest of the record."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("bigint")


def fisher_yates(number: int, random: np.random.Generator) -> np.ndarray:
    """A random order: from the last place down, swap with a random place up to it."""
    order = np.arange(number)
    picks = (random.random(number) * np.arange(1, number + 1)).astype(np.int64)
    for last in range(number - 1, 0, -1):
        other = picks[last]
        order[last], order[other] = order[other], order[last]
    return order


def _shuffled(seed: int):
    def shuffle(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        shard, bucket = rows.column("shard")[0].as_py(), rows.column("bucket")[0].as_py()
        order = fisher_yates(len(rows), np.random.default_rng([seed, shard, bucket]))
        rows = rows.drop_columns(["place"]).take(pa.array(order))
        return rows.append_column("position", pa.array(np.arange(len(rows), dtype=np.int64)))

    return shuffle


def write_shards(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> str:
    """Write the shuffled shards as Parquet, a folder ``shard=N`` each; returns the folder.

    A file's rows are in shuffled order; ``bucket`` and ``position`` give a record's place
    in its shard. Null texts stay null, repeated rows are records of their own, an empty
    table makes an empty folder. Columns of the input are kept in the struct ``record``,
    so none of their names clashes.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(record_size(F.col("text")))).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    dealt = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
        shard_of(F.col("doc_id"), shards, seed).alias("shard"),
        F.monotonically_increasing_id().alias("place"),
    ).withColumn(
        "bucket",
        F.pmod(F.xxhash64("record.doc_id", "place", F.lit(seed + 1)), F.lit(buckets)).cast("int"),
    )
    fields = dealt.drop("place").schema.fields
    shuffled = dealt.groupBy("shard", "bucket").applyInArrow(
        _shuffled(seed), T.StructType([*fields, T.StructField("position", T.LongType())])
    )
    folder = working_folder(spark, "shards")
    ordered = shuffled.sortWithinPartitions("shard", "bucket", "position")
    ordered.write.partitionBy("shard").parquet(folder)
    return folder


def read_shards(spark: SparkSession, folder: str, docs: DataFrame) -> DataFrame:
    """The written records (as the struct ``record`` of the columns of ``docs``) with their
    shard and their slot in it, counted from 0 without a gap."""
    fields = [
        T.StructField("record", docs.schema), T.StructField("bucket", T.IntegerType()),
        T.StructField("position", T.LongType()), T.StructField("shard", T.IntegerType()),
    ]
    written = spark.read.schema(T.StructType(fields)).parquet(folder)
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One row per bucket: a sixteen-megabyte share of the input each.
    sizes = written.groupBy("shard", "bucket").count().select(
        "shard", "bucket", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before")
    )
    return written.join(sizes, ["shard", "bucket"]).select(
        "record", "shard", (F.col("before") + F.col("position")).alias("slot")
    )
