"""Jobs that move data between layers. Each may be run again for the same date with the
same result, and takes its dates as arguments; a scheduler decides when."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse import schemas as S
from tillhouse.operators.governance import retain
from tillhouse.operators.survivors import keep_newest
from tillhouse.operators.screening import REASON, failing, passing, require_columns
from tillhouse.plans import marketing, operations, sales, support
from tillhouse.plans.periods import Period
from tillhouse.plans.silver import (
    CRM,
    INVENTORY,
    POS,
    WTL,
    SilverTable,
    keeps_keys,
    keyed,
    keyless,
    project,
    survivors,
)
from tillhouse.session import working_folder
from tillhouse.sinks import folders, key_index, versions
from tillhouse.sinks.reports import dated_folder, load_mart, write_csv
from tillhouse.sinks.tables import purge, remove_rows, upsert
from tillhouse.sources.tables import read_table


@dataclass(frozen=True)
class Lake:
    """Folders of the layers below one root. Refused rows lie outside of all tables, so
    that no scan of a table meets them."""

    root: str

    def bronze(self, feed: str) -> str:
        return f"{self.root}/bronze/{feed}"

    def silver(self, table: SilverTable) -> str:
        return f"{self.root}/silver/{table.name}"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    def mart(self, mart: S.Mart) -> str:
        return f"{self.root}/marts/{mart.name}"

    @property
    def rejected(self) -> str:
        return f"{self.root}/rejected"


def refresh_silver(
    spark: SparkSession,
    lake: Lake,
    bronze: DataFrame,
    table: SilverTable,
    date: dt.date,
    run: str = "daily",
) -> None:
    """Deduplicate and check a feed, upsert the good rows, set the others aside.

    Rows whose typed key is incomplete are set aside first, every one of them, since a
    deduplication would take them for copies of one row. Refused rows lie by date, run and
    reason; a run that is repeated replaces its own, other runs of the date (name them by
    hour or batch) stay. Accepted rows, refused rows and copies together are the input.

    The deduplicated rows are stored once in the working folder, since two consumers read
    them: the upsert and the refused rows. Where typing may make two keys one, the upsert
    deduplicates once more.
    """
    require_columns(bronze, table.keys)
    folder = working_folder(spark, f"survivors-{table.name}")
    survivors(keyed(bronze, table), table).write.parquet(folder)
    rows = spark.read.parquet(folder)
    good = project(passing(rows, table.checks()), table)
    as_stored = keeps_keys(bronze, table)
    upsert(spark, lake.silver(table), good, table, unique=as_stored, stored=as_stored)
    (
        failing(rows, table.checks())
        .unionByName(keyless(bronze, table))
        .write.mode("overwrite")
        .partitionBy(REASON)
        .json(f"{dated_folder(lake.rejected, table.name, date)}/run={run}")
    )
    folders.remove(spark, folder)
    versions.remove_old(spark, lake.silver(table), table.partitions)


def read_rejects(spark: SparkSession, lake: Lake, table: SilverTable) -> DataFrame:
    """Refused rows of a table: all runs of all dates, with ``reject_reason``, ``run`` and
    the date as ``year``, ``month``, ``day``."""
    names = [f.name for f in table.bronze]
    texts = [T.StructField(name, T.StringType()) for name in [*names, REASON, "run"]]
    dates = [T.StructField(name, T.IntegerType()) for name in ("year", "month", "day")]
    path = f"{lake.rejected}/{table.name}"
    return spark.read.schema(T.StructType([*texts, *dates])).json(path)


def read_silver(
    spark: SparkSession, lake: Lake, table: SilverTable, period: Period | None = None
) -> DataFrame:
    """A silver table, or an empty frame of its schema when it was never written."""
    path = lake.silver(table)
    if not folders.exists(spark, path):
        return spark.createDataFrame([], table.schema)
    return read_table(spark, path, table.schema, period)


def publish(
    spark: SparkSession, lake: Lake, gold: DataFrame, mart: S.Mart, date: dt.date
) -> None:
    """Gold CSV of the date, then the typed mart from that file."""
    folder = write_csv(gold, lake.gold, mart.name, date)
    load_mart(spark, folder, mart, lake.mart(mart))


def refresh_sales(
    spark: SparkSession,
    lake: Lake,
    date: dt.date,
    sales_period: Period | None = None,
    inventory_period: Period | None = None,
) -> None:
    """Sales mart of a date; both periods default to that day."""
    pos = read_silver(spark, lake, POS, sales_period or Period.day_of(date))
    inventory = read_silver(spark, lake, INVENTORY, inventory_period or Period.day_of(date))
    publish(spark, lake, sales.sales_mart(pos, inventory, date), S.SALES_MART, date)


def refresh_marketing(spark: SparkSession, lake: Lake, date: dt.date) -> None:
    """Marketing mart of a day."""
    day = Period.day_of(date)
    wtl, crm = read_silver(spark, lake, WTL, day), read_silver(spark, lake, CRM, day)
    publish(spark, lake, marketing.marketing_mart(wtl, crm, date), S.MARKETING_MART, date)


def refresh_operations(spark: SparkSession, lake: Lake, date: dt.date) -> None:
    """Operations metrics of a day as CSV, and the operations mart."""
    day = Period.day_of(date)
    pos, inventory = read_silver(spark, lake, POS, day), read_silver(spark, lake, INVENTORY, day)
    root = f"{lake.gold}/operations_kpis"
    write_csv(operations.inventory_turnover(pos, inventory), root, "inventory_turnover", date)
    write_csv(operations.restock_frequency(inventory), root, "restock_frequency", date)
    write_csv(operations.stockout_alerts(inventory), root, "stockout_alerts", date)
    publish(spark, lake, operations.operations_mart(pos, inventory, date), S.OPERATIONS_MART, date)


def support_history(spark: SparkSession, lake: Lake, date: dt.date) -> DataFrame:
    """Interactions of a day, and the earlier ones of the customers resolved on it."""
    path = lake.silver(CRM)
    if not versions.is_versioned(spark, path):
        return spark.createDataFrame([], CRM.schema)
    today = read_silver(spark, lake, CRM, Period.day_of(date))
    resolved = today.where(F.col("interaction_type") == S.RESOLUTION).select(CRM.owner)
    opened = key_index.folders_of(spark, path, resolved, CRM.schema, CRM.owner)
    opened = {f for f in opened if Period.may_begin_before(f, date)}
    earlier = versions.read(spark, path, CRM.schema, only=opened).where(F.col("date") < F.lit(date))
    return earlier.unionByName(today)


def refresh_support(spark: SparkSession, lake: Lake, date: dt.date) -> None:
    """Support metrics of a day as single CSV files, and the support mart.

    A Resolution may answer an interaction of an earlier day, so the mart also reads the
    folders of the customers with a Resolution on the day, which the index of owners tells.
    """
    crm = read_silver(spark, lake, CRM, Period.day_of(date))
    history = support_history(spark, lake, date)
    root = f"{lake.gold}/customer_support_kpis"
    write_csv(support.feedback_score(crm), root, "feedback_score", date, single_file=True)
    write_csv(support.interaction_volume(crm), root, "interaction_volume", date, single_file=True)
    publish(spark, lake, support.daily_support_mart(history, date), S.SUPPORT_MART, date)


def purge_users(
    spark: SparkSession,
    lake: Lake,
    table: SilverTable,
    as_of: dt.date,
    keep_days: int,
    forgotten: DataFrame,
    user_column: str,
) -> None:
    """Delete rows of forgotten users and rows past their retention from a silver table.
    Only folders that are old or may hold a forgotten user are opened. The versions before
    hold the rows until ``versions.remove_old`` removes them.

    ``forgotten`` holds the ids in a column named like ``user_column``.
    """

    def retained(rows: DataFrame) -> DataFrame:
        return retain(rows, as_of, keep_days, forgotten, user_column)

    path = lake.silver(table)
    if table.owner == user_column:
        oldest = as_of - dt.timedelta(days=keep_days)
        purge(spark, path, table, retained, oldest, forgotten)
    else:
        remove_rows(spark, path, table, retained)


def merge_landed(
    spark: SparkSession, lake: Lake, landed: DataFrame, table: SilverTable, arrival: str
) -> None:
    """Bring landed records into a silver table, the latest to arrive last.

    Where a stream drops copies only within the bound of its watermark, this merge by key
    catches the later ones: a copy replaces the stored row. Run again over the same batches,
    it leaves the table as it is."""
    rows = keep_newest(landed, table.keys, arrival).drop(arrival)
    good = project(passing(keyed(rows, table), table.checks()), table)
    upsert(spark, lake.silver(table), good, table)
    versions.remove_old(spark, lake.silver(table), table.partitions)
