"""Gold results as CSV in dated folders, and their way into typed marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.schemas import Mart
from tillhouse.sinks import folders, versions


def dated_folder(root: str, name: str, date: dt.date) -> str:
    return f"{root.rstrip('/')}/{name}/year={date:%Y}/month={date:%m}/day={date:%d}"


def write_csv(
    df: DataFrame, root: str, name: str, date: dt.date, single_file: bool = False
) -> str:
    """CSV with header in the folder of the date; a second run replaces the first.

    ``single_file`` is meant for metric frames of a few rows. It moves the finished
    rows to one task and leaves the computation before that parallel.
    """
    folder = dated_folder(root, name, date)
    frame = df.repartition(1) if single_file else df
    frame.write.mode("overwrite").option("header", True).csv(folder)
    return folder


def read_gold(spark: SparkSession, folder: str, mart: Mart) -> DataFrame:
    """Rows of a gold CSV folder under the mart's columns, matched by position.

    A value that does not fit its column is an error, as in a warehouse load, with ANSI
    mode on or off.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in mart.schema])
    rows = spark.read.schema(text).option("header", True).csv(folder)
    fitted = []
    for field in mart.schema:
        text, value = F.col(field.name), F.col(field.name).try_cast(field.dataType)
        message = F.concat(F.lit(f"{mart.name}.{field.name} cannot hold "), text)
        refuse = F.raise_error(message).cast(field.dataType)
        lost = text.isNotNull() & value.isNull()
        fitted.append(F.when(lost, refuse).otherwise(value).alias(field.name))
    return rows.select(*fitted)


def fit_mart(df: DataFrame, mart: Mart) -> DataFrame:
    """Gold columns in mart order and type."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in mart.schema])


def mart_violations(df: DataFrame, mart: Mart) -> DataFrame:
    """Keys with a null part or more than one row: empty for a sound mart."""
    incomplete = F.expr(" OR ".join(f"{k} IS NULL" for k in mart.key))
    return (
        df.groupBy(*mart.key)
        .agg(F.count("*").alias("row_count"))
        .where(incomplete | (F.col("row_count") > 1))
        .withColumn("problem", F.when(incomplete, "null_key").otherwise("repeated_key"))
    )


def check_mart(df: DataFrame, mart: Mart) -> None:
    """Raise when the key of a mart is broken, with the number of such keys and one of them."""
    broken = mart_violations(df, mart)
    found = broken.agg(F.count("*").alias("keys"), F.any_value(F.struct(*broken.columns)).alias("one"))
    result = found.first()
    if result["keys"]:
        raise ValueError(f"{mart.name}: {result['keys']} broken keys, such as {result['one'].asDict()}")


def load_mart(spark: SparkSession, folder: str, mart: Mart, path: str) -> None:
    """Store a gold folder typed, by date, if it keeps the mart contract.

    The rows are written as the next version of the mart. The keys are checked there, on
    stored columns, and the version counts afterwards, so a refused or interrupted load
    leaves the mart as it was and loading a date again replaces it.
    """
    number, staged = versions.stage(spark, path)
    (
        read_gold(spark, folder, mart)
        .hint("rebalance")
        .sortWithinPartitions(mart.sort, *mart.key)
        .write.mode("overwrite")
        .partitionBy(mart.sort)
        .parquet(staged)
    )
    try:
        check_mart(spark.read.schema(mart.schema).parquet(staged), mart)
    except ValueError:
        folders.remove(spark, staged if number > 1 else path)
        raise
    versions.commit(spark, path, number, [mart.sort], ())


def read_mart(spark: SparkSession, path: str, mart: Mart) -> DataFrame:
    """The rows of a typed mart."""
    return versions.read(spark, path, mart.schema)
