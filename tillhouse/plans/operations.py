"""Stock turnover, restock and stockout counts, operations mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.columns import ratio


def _on_day(df: DataFrame, time_column: str, day: dt.date | None) -> DataFrame:
    """Rows of a day, as a range on the time itself, which a scan can use to skip data."""
    if day is None:
        return df
    start, end = (F.lit(d).cast("timestamp") for d in (day, day + dt.timedelta(days=1)))
    return df.where((F.col(time_column) >= start) & (F.col(time_column) < end))


def _at_threshold() -> Column:
    return F.col("stock_level") <= F.col("restock_threshold")


def _sold_out() -> Column:
    return F.col("stock_level") <= 0


def _units_sold(pos: DataFrame, day: dt.date | None) -> DataFrame:
    return (
        _on_day(pos, "timestamp", day)
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("total_quantity_sold"))
    )


def _turnover() -> Column:
    return ratio(F.col("total_quantity_sold"), F.col("avg_inventory_level"), otherwise=None)


def inventory_turnover(
    pos: DataFrame, inventory: DataFrame, day: dt.date | None = None
) -> DataFrame:
    """Units sold over mean stock per product; null without positive stock.

    ``day`` restricts both sides to events of that day. Unsold products are absent.
    """
    stock = (
        _on_day(inventory, "last_updated", day)
        .groupBy("product_id")
        .agg(F.avg("stock_level").alias("avg_inventory_level"))
    )
    return (
        _units_sold(pos, day)
        .join(stock, "product_id", "left")
        .select("product_id", _turnover().alias("inventory_turnover"))
    )


def restock_frequency(inventory: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Records at or below their threshold, per product and warehouse."""
    return (
        _on_day(inventory, "last_updated", day)
        .where(_at_threshold())
        .groupBy("product_id", "warehouse_id")
        .agg(F.count("*").alias("restock_frequency"))
    )


def stockout_alerts(inventory: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Records with no stock left, per product and warehouse."""
    return (
        _on_day(inventory, "last_updated", day)
        .where(_sold_out())
        .groupBy("product_id", "warehouse_id")
        .agg(F.count("*").alias("stockout_count"))
    )


def operations_mart(
    pos: DataFrame,
    inventory: DataFrame,
    processing_date: dt.date,
    day: dt.date | None = None,
) -> DataFrame:
    """Turnover, restock count and stockout risk of each product sold or stocked.

    Risk: HIGH when some record has no stock, MEDIUM when some record is at or below
    its threshold, else LOW. One pass over inventory serves all three figures.
    """
    stock = (
        _on_day(inventory, "last_updated", day)
        .groupBy("product_id")
        .agg(
            F.avg("stock_level").alias("avg_inventory_level"),
            F.count_if(_at_threshold()).alias("restock_count"),
            F.count_if(_sold_out()).alias("stockouts"),
        )
    )
    risk = (
        F.when(F.col("stockouts") > 0, "HIGH")
        .when(F.col("restock_count") > 0, "MEDIUM")
        .otherwise("LOW")
    )
    return (
        _units_sold(pos, day)
        .join(stock, "product_id", "full")
        .where(F.col("product_id").isNotNull())
        .select(
            "product_id",
            _turnover().alias("inventory_turnover"),
            F.coalesce("restock_count", F.lit(0)).alias("restock_count"),
            risk.alias("stockout_risk"),
            F.lit(processing_date).alias("date"),
        )
    )
