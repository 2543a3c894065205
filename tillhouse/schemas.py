"""Explicit schemas for every layer; nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

INT = T.IntegerType()
LONG = T.LongType()
FLOAT = T.FloatType()
DOUBLE = T.DoubleType()
TEXT = T.StringType()
BOOL = T.BooleanType()
DATE = T.DateType()
TIMESTAMP = T.TimestampType()


def struct_of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# --- interaction and event names as silver stores them (upper case) ----------------
FEEDBACK = "FEEDBACK"
RESOLUTION = "RESOLUTION"
COMPLAINT = "COMPLAINT"
LOYALTY_ACTION = "LOYALTY_ACTION"
PAGE_VIEW = "PAGE_VIEW"
BOUNCE = "BOUNCE"
CLICK = "CLICK"
UNKNOWN = "UNKNOWN"

# The column names and types of all layers are a contract with other
# systems. Ids and sums of units are bigint, wider than there: they outgrow int.

# --- bronze: the shape in which the four feeds arrive, times as epoch seconds ------
BRONZE_POS = struct_of(
    transaction_id=TEXT, store_id=LONG, product_id=LONG, quantity=INT,
    revenue=DOUBLE, discount_applied=DOUBLE, timestamp=LONG,
)
BRONZE_INVENTORY = struct_of(
    inventory_id=LONG, product_id=LONG, warehouse_id=INT, stock_level=INT,
    restock_threshold=INT, last_updated=LONG,
)
BRONZE_CRM = struct_of(
    customer_id=LONG, interaction_type=TEXT, channel=TEXT, rating=INT,
    message_excerpt=TEXT, timestamp=LONG,
)
BRONZE_WTL = struct_of(
    session_id=TEXT, user_id=LONG, page=TEXT, device_type=TEXT, browser=TEXT,
    event_type=TEXT, timestamp=LONG,
)

# Live records carry whatever the sender wrote, so every field is read as text and
# cast by the operator that needs a number.
LIVE_CRM = struct_of(
    customer_id=TEXT, interaction_type=TEXT, channel=TEXT, rating=TEXT,
    message_excerpt=TEXT, timestamp=TEXT,
)
LIVE_WTL = struct_of(
    session_id=TEXT, user_id=TEXT, page=TEXT, device_type=TEXT, browser=TEXT,
    event_type=TEXT, timestamp=TEXT,
)

# --- silver ------------------------------------------------------------------------
SILVER_POS = struct_of(
    transaction_id=TEXT, store_id=LONG, product_id=LONG, quantity=INT, revenue=FLOAT,
    discount_applied=FLOAT, net_revenue=FLOAT, timestamp=TIMESTAMP, date=DATE,
    year=INT, month=INT, day=INT,
)
SILVER_INVENTORY = struct_of(
    inventory_id=LONG, product_id=LONG, warehouse_id=INT, stock_level=INT,
    restock_threshold=INT, needs_restock=BOOL, last_updated=TIMESTAMP,
    year=INT, month=INT, day=INT, hour=INT,
)
SILVER_CRM = struct_of(
    customer_id=LONG, interaction_type=TEXT, channel=TEXT, rating=INT,
    message_excerpt=TEXT, timestamp=TIMESTAMP, date=DATE,
    year=INT, month=INT, day=INT, hour=INT,
)
SILVER_WTL = struct_of(
    session_id=TEXT, user_id=LONG, hashed_user_id=TEXT, page=TEXT, device_type=TEXT,
    browser=TEXT, event_type=TEXT, timestamp=TIMESTAMP, date=DATE, is_anonymous=BOOL,
    year=INT, month=INT, day=INT, hour=INT,
)


# --- marts: typed contract of the warehouse tables ---------------------------------
@dataclass(frozen=True)
class Mart:
    """Column order, types and primary key of a warehouse table.

    Loading is positional, so the order of ``schema`` is part of the contract. The
    key columns may not be null and must identify a row.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    sort: str = "date"


SALES_MART = Mart(
    "sales_mart",
    struct_of(
        product_id=LONG, store_id=LONG, total_sales=DOUBLE, total_units=LONG,
        stock_availability=INT, below_restock_threshold=BOOL,
        product_turnover_rate=DOUBLE, date=DATE,
    ),
    ("product_id", "store_id", "date"),
)
MARKETING_MART = Mart(
    "marketing_mart",
    struct_of(
        customer_id=LONG, engagement_score=T.DecimalType(5, 2),
        avg_session_duration=T.DecimalType(10, 2), bounce_rate=DOUBLE,
        loyalty_activity_rate=DOUBLE, loyalty_actions=INT, date=DATE,
    ),
    ("customer_id", "date"),
)
OPERATIONS_MART = Mart(
    "operations_mart",
    struct_of(
        product_id=LONG, inventory_turnover=T.DecimalType(10, 2), restock_count=INT,
        stockout_risk=TEXT, date=DATE,
    ),
    ("product_id", "date"),
)
SUPPORT_MART = Mart(
    "customer_support_mart",
    struct_of(
        customer_id=LONG, avg_rating=T.DecimalType(3, 1), complaint_count=INT,
        feedback_count=INT, loyalty_count=INT,
        avg_resolution_hours=T.DecimalType(6, 2), date=DATE,
    ),
    ("customer_id", "date"),
)
MARTS = {m.name: m for m in (SALES_MART, MARKETING_MART, OPERATIONS_MART, SUPPORT_MART)}

# --- gold metric frames ------------------------------------------------------------
INTERACTION_VOLUME = struct_of(interaction_type=TEXT, volume=LONG)
