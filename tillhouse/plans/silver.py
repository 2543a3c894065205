"""The four silver tables.

Each is described by data: the key and how a survivor is chosen, the checks a row must
pass, the output columns as expressions over the raw row, and the partition columns.
``refine`` applies a description. Deduplication comes before the checks: a newer bad
row hides an older good one, as the pipeline's rules ask, and so a check may not be
pushed below it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse import schemas as S
from tillhouse.functions.columns import (
    calendar_parts,
    moment,
    number,
    sha256_hex,
    title_or_unknown,
    upper_or_unknown,
)
from tillhouse.operators.screening import failing, passing, require_columns, with_broken_key
from tillhouse.operators.survivors import keep_newest

DAILY = ("year", "month", "day")
HOURLY = (*DAILY, "hour")


@dataclass(frozen=True)
class SilverTable:
    """Rules of one silver table.

    ``key_fixes_partition`` is true where the partition columns are computed from the
    key, so that a changed row stays in its partition and an upsert need not look for
    it elsewhere. ``key_as_sent`` is true where the key's columns are those of the feed, save
    for a cast. ``owner`` is the person whose rows the table holds.
    """

    name: str
    bronze: T.StructType
    schema: T.StructType
    keys: tuple[str, ...]
    time_column: str
    partitions: tuple[str, ...]
    checks: Callable[[], dict[str, Column]]
    columns: Callable[[], dict[str, Column]]
    key_fixes_partition: bool = False
    key_as_sent: bool = False
    owner: str | None = None


def _discount() -> Column:
    return F.when(F.col("discount_applied").isNull(), 0.0).otherwise(
        number("discount_applied", "double")
    )


def _pos_checks() -> dict[str, Column]:
    return {
        "bad_quantity": number("quantity", "int") >= 0,
        "bad_revenue": number("revenue", "double") >= 0,
        "bad_discount": _discount().isNotNull(),
    }


def _pos_columns() -> dict[str, Column]:
    sold_at = moment("timestamp")
    revenue = number("revenue", "double")
    discount = _discount()
    return {
        "transaction_id": F.col("transaction_id"),
        "store_id": F.col("store_id"),
        "product_id": F.col("product_id"),
        "quantity": F.col("quantity"),
        "revenue": revenue,
        "discount_applied": discount,
        "net_revenue": revenue - discount,
        "timestamp": sold_at,
        "date": F.to_date(sold_at),
        # The day of the sale, not the day the file landed.
        **calendar_parts(sold_at, hour=False),
    }


def _threshold() -> Column:
    return F.when(F.col("restock_threshold").isNull(), 0).otherwise(
        number("restock_threshold", "int")
    )


def _inventory_checks() -> dict[str, Column]:
    return {
        "bad_stock_level": number("stock_level", "int") >= 0,
        "bad_restock_threshold": _threshold() >= 0,
    }


def _inventory_columns() -> dict[str, Column]:
    updated = moment("last_updated")
    return {
        "inventory_id": F.col("inventory_id"),
        "product_id": F.col("product_id"),
        "warehouse_id": F.col("warehouse_id"),
        "stock_level": F.col("stock_level"),
        "restock_threshold": _threshold(),
        "needs_restock": number("stock_level", "int") <= _threshold(),
        "last_updated": updated,
        **calendar_parts(updated),
    }


def _crm_checks() -> dict[str, Column]:
    # Text that is no number counts as "not rated"; only a real number can be out of range.
    rating = number("rating", "double")
    return {"rating_out_of_range": rating.isNull() | rating.between(1, 5)}


def _crm_columns() -> dict[str, Column]:
    at = moment("timestamp")
    return {
        "customer_id": F.col("customer_id"),
        "interaction_type": F.upper("interaction_type"),
        "channel": upper_or_unknown("channel"),
        "rating": number("rating", "double"),
        "message_excerpt": F.coalesce(sha256_hex(F.col("message_excerpt")), F.lit("")),
        "timestamp": at,
        "date": F.to_date(at),
        **calendar_parts(at),
    }


def _wtl_columns() -> dict[str, Column]:
    at = moment("timestamp")
    return {
        "session_id": F.col("session_id"),
        "user_id": F.col("user_id"),
        "hashed_user_id": sha256_hex(F.col("user_id")),
        "page": F.col("page"),
        "device_type": title_or_unknown("device_type"),
        "browser": title_or_unknown("browser"),
        "event_type": upper_or_unknown("event_type"),
        "timestamp": at,
        "date": F.to_date(at),
        "is_anonymous": F.col("user_id").isNull(),
        **calendar_parts(at),
    }


POS = SilverTable(
    "pos", S.BRONZE_POS, S.SILVER_POS, ("transaction_id",), "timestamp", DAILY,
    _pos_checks, _pos_columns, key_as_sent=True,
)
INVENTORY = SilverTable(
    "inventory", S.BRONZE_INVENTORY, S.SILVER_INVENTORY, ("inventory_id",),
    "last_updated", DAILY, _inventory_checks, _inventory_columns, key_as_sent=True,
)
CRM = SilverTable(
    "customer_interaction", S.BRONZE_CRM, S.SILVER_CRM, ("customer_id", "timestamp"),
    "timestamp", DAILY, _crm_checks, _crm_columns, key_fixes_partition=True, owner="customer_id",
)
WTL = SilverTable(
    "wtl", S.BRONZE_WTL, S.SILVER_WTL, ("session_id", "timestamp"), "timestamp", HOURLY,
    dict, _wtl_columns, key_fixes_partition=True, owner="user_id",
)
TABLES = {t.name: t for t in (POS, INVENTORY, CRM, WTL)}


def survivors(bronze: DataFrame, table: SilverTable) -> DataFrame:
    """Raw rows after deduplication, before the checks. Rows with a null key form one
    group; a job sets them aside before (``keyless``)."""
    require_columns(bronze, table.keys)
    return keep_newest(bronze, table.keys, table.time_column)


def _typed(table: SilverTable) -> dict[str, Column]:
    expressions = table.columns()
    return {f.name: expressions[f.name].try_cast(f.dataType) for f in table.schema}


def project(rows: DataFrame, table: SilverTable) -> DataFrame:
    """Final typed columns in table order."""
    return rows.select(*[value.alias(name) for name, value in _typed(table).items()])


def refine(bronze: DataFrame, table: SilverTable) -> DataFrame:
    """Raw feed to silver rows."""
    return project(passing(survivors(bronze, table), table.checks()), table)


def rejects(bronze: DataFrame, table: SilverTable) -> DataFrame:
    """Raw rows a silver table refused, with the reason.

    Together: silver rows + rejects + dropped copies = input rows.
    """
    return failing(survivors(bronze, table), table.checks())


def keyless(rows: DataFrame, table: SilverTable) -> DataFrame:
    """Raw rows whose key is incomplete, or is so once typed: an upsert cannot place them."""
    typed = _typed(table)
    return with_broken_key(rows, [typed[key] for key in table.keys])


def keyed(rows: DataFrame, table: SilverTable) -> DataFrame:
    """Raw rows whose key is complete once typed: the complement of ``keyless``."""
    typed = _typed(table)
    return rows.where(reduce(and_, [typed[key].isNotNull() for key in table.keys]))


def keeps_keys(bronze: DataFrame, table: SilverTable) -> bool:
    """Typing changes no key, so that one row per raw key is one row per typed key."""
    types = {field.name.lower(): field.dataType for field in bronze.schema}
    return table.key_as_sent and all(
        types[key.lower()] == table.schema[key].dataType for key in table.keys
    )


def silver_pos(bronze: DataFrame) -> DataFrame:
    """Sales: one row per transaction, non-negative quantity and revenue."""
    return refine(bronze, POS)


def silver_inventory(bronze: DataFrame) -> DataFrame:
    """Stock levels: one row per inventory record, threshold filled with 0."""
    return refine(bronze, INVENTORY)


def silver_crm(bronze: DataFrame) -> DataFrame:
    """Customer interactions: one row per customer and second, excerpt hashed."""
    return refine(bronze, CRM)


def silver_wtl(bronze: DataFrame) -> DataFrame:
    """Web traffic: one row per session and second, user id hashed beside the raw id."""
    return refine(bronze, WTL)
