"""Sales mart and revenue reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.columns import holds, ratio
from tillhouse.plans.periods import Period, within


def stock_position(inventory: DataFrame) -> DataFrame:
    """Best stock level and highest threshold of each product over its warehouses."""
    return inventory.groupBy("product_id").agg(
        F.max("stock_level").alias("stock_availability"),
        F.max("restock_threshold").alias("restock_threshold"),
    )


def _with_stock(sales: DataFrame, inventory: DataFrame, processing_date: dt.date) -> DataFrame:
    short = F.col("stock_availability") < F.col("restock_threshold")
    return sales.join(stock_position(inventory), "product_id").select(
        "product_id",
        "store_id",
        "total_sales",
        "total_units",
        "stock_availability",
        holds(short).alias("below_restock_threshold"),
        ratio(F.col("total_units"), F.col("stock_availability")).alias("product_turnover_rate"),
        F.lit(processing_date).alias("date"),
    )


def sales_mart(
    pos: DataFrame,
    inventory: DataFrame,
    processing_date: dt.date,
    sales_period: Period | None = None,
    inventory_period: Period | None = None,
) -> DataFrame:
    """Sales of each product in each store beside the product's stock.

    Grouped by the key of the mart, (product_id, store_id); ``sales_by_store`` has the
    coarser store-only shape. Products without stock records do not appear. Both sides
    are aggregated before the join, so no hot product multiplies rows.
    """
    sales = (
        within(pos, sales_period)
        .groupBy("product_id", "store_id")
        .agg(F.sum("revenue").alias("total_sales"), F.sum("quantity").alias("total_units"))
    )
    return _with_stock(sales, within(inventory, inventory_period), processing_date)


def sales_by_store(
    pos: DataFrame,
    inventory: DataFrame,
    processing_date: dt.date,
    sales_period: Period | None = None,
    inventory_period: Period | None = None,
) -> DataFrame:
    """Store totals labelled with one product: that of the store's earliest sale, of
    several at that time the least product.

    Sums and the first time of each (store, product) come from a hash aggregate over all
    sales; the label is found among those few rows, without a sort.
    """
    chosen = within(pos, sales_period)
    by_product = chosen.groupBy("store_id", "product_id").agg(
        F.sum("revenue").alias("total_sales"),
        F.sum("quantity").alias("total_units"),
        F.min("timestamp").alias("first_sale"),
    )
    totals = by_product.groupBy("store_id").agg(
        F.sum("total_sales").alias("total_sales"),
        F.sum("total_units").alias("total_units"),
        F.min("first_sale").alias("first_of_store"),
    )
    each, store = by_product.alias("each"), totals.alias("store")
    at_first = F.col("each.store_id").eqNullSafe(F.col("store.store_id")) & F.col(
        "each.first_sale"
    ).eqNullSafe(F.col("store.first_of_store"))
    sales = (
        store.join(each, at_first)
        .groupBy("store.store_id", "store.total_sales", "store.total_units")
        .agg(F.min("each.product_id").alias("product_id"))
    )
    return _with_stock(sales, within(inventory, inventory_period), processing_date)


def _revenue(pos: DataFrame, by: str) -> DataFrame:
    return pos.groupBy(by).agg(
        F.sum("revenue").alias("gross_revenue"),
        F.sum("discount_applied").alias("discounts"),
        F.sum("net_revenue").alias("net_sales"),
        F.sum("quantity").alias("units"),
        F.count("*").alias("transactions"),
    )


def daily_net_sales(pos: DataFrame) -> DataFrame:
    """Revenue, discounts and net sales of each day."""
    return _revenue(pos, "date")


def store_revenue(pos: DataFrame) -> DataFrame:
    """Revenue, discounts and net sales of each store."""
    return _revenue(pos, "store_id")
