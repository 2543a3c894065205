"""JSON files: one object per line (gzip or plain), or one array per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CORRUPT = "corrupt_record"


def _reader(spark: SparkSession, schema: T.StructType, keep_corrupt: bool):
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False
) -> DataFrame:
    """Newline-delimited records. A broken line gives nulls; ``keep_corrupt`` adds the
    line itself as ``corrupt_record``. Compression is told by the file name."""
    return _reader(spark, schema, keep_corrupt).json(path)


def read_json_arrays(
    spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False
) -> DataFrame:
    """Files that hold one JSON array, one row per element.

    Such a file cannot be split, so its size bounds the parallelism within it.
    """
    return _reader(spark, schema, keep_corrupt).option("multiLine", True).json(path)
