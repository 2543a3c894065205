"""Who may see which rows and columns, hashing of ids, and deletion of user rows."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.columns import holds, salted_sha256_hex


@dataclass(frozen=True)
class View:
    """Columns a team sees in a table and an optional SQL row condition."""

    columns: tuple[str, ...]
    row_filter: str | None = None


# Tables per team. Raw user ids and message hashes are shown to nobody.
TEAM_VIEWS = {
    ("sales", "pos"): View(
        ("transaction_id", "store_id", "product_id", "quantity", "revenue",
         "discount_applied", "net_revenue", "date"),
    ),
    ("sales", "inventory"): View(
        ("product_id", "warehouse_id", "stock_level", "needs_restock", "last_updated"),
    ),
    ("marketing", "wtl"): View(
        ("session_id", "hashed_user_id", "page", "device_type", "browser", "event_type",
         "timestamp", "date", "is_anonymous"),
    ),
    ("marketing", "customer_interaction"): View(
        ("customer_id", "interaction_type", "channel", "rating", "date"),
    ),
    ("operations", "inventory"): View(
        ("inventory_id", "product_id", "warehouse_id", "stock_level", "restock_threshold",
         "needs_restock", "last_updated"),
    ),
    ("operations", "pos"): View(("store_id", "product_id", "quantity", "date")),
    ("support", "customer_interaction"): View(
        ("customer_id", "interaction_type", "channel", "rating", "timestamp", "date"),
        "interaction_type <> 'LOYALTY_ACTION'",
    ),
}


def team_view(
    df: DataFrame,
    team: str,
    table: str,
    row_filter: str | None = None,
    allowed: DataFrame | None = None,
    salt: str | None = None,
) -> DataFrame:
    """The part of a table a team may read.

    Where a view shows ``hashed_user_id``, it is the digest with the ``salt``, which is
    required then: the digest without it is undone by counting upwards.

    ``row_filter`` narrows it further (``store_id = 103``). ``allowed`` is a policy
    table: only rows whose values of its columns occur there are kept.
    """
    try:
        view = TEAM_VIEWS[team, table]
    except KeyError:
        raise PermissionError(f"team {team!r} has no access to {table!r}") from None
    if "hashed_user_id" in view.columns:
        if not salt:
            raise ValueError(f"{table} for {team} needs a salt")
        df = df.withColumn("hashed_user_id", salted_sha256_hex(F.col("user_id"), salt))
    for condition in (view.row_filter, row_filter):
        if condition:
            df = df.where(condition)
    if allowed is not None:
        df = df.join(allowed, allowed.columns, "left_semi")
    return df.select(*view.columns)


def hash_users(df: DataFrame, salt: str, column: str = "user_id") -> DataFrame:
    """Replace an id by its salted digest; the digest without salt goes as well."""
    digest = salted_sha256_hex(F.col(column), salt)
    return df.withColumn(f"hashed_{column}", digest).drop(column)


def retain(
    df: DataFrame,
    as_of: dt.date,
    keep_days: int,
    forgotten: DataFrame | None = None,
    user_column: str = "customer_id",
    date_column: str = "date",
) -> DataFrame:
    """Rows that stay: not older than ``keep_days`` and not of a forgotten user.

    Rows without a date are kept, since their age is unknown.
    """
    oldest = as_of - dt.timedelta(days=keep_days)
    kept = df.where(~holds(F.col(date_column) < F.lit(oldest)))
    if forgotten is None:
        return kept
    return kept.join(forgotten.select(user_column), user_column, "left_anti").select(*df.columns)
