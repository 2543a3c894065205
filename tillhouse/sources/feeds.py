"""The four raw feeds, derived from the retail test tables.

Each function is a projection (and at most a fixed fan-out) of one table, so it works on
batch frames and on streams. ``keep`` carries further columns of the table along. The
remainders used below are fixed values: they spread the defects a real feed has
(negative quantities, missing thresholds, odd letter case, unusable ratings) over the
rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.sources.envelopes import encode

NEWEST_STOCK_COUNT = 897_868_800  # 1998-06-15 00:00 UTC
WAREHOUSES = 5


def _epoch(name: str) -> Column:
    return F.unix_seconds(F.col(name).cast("timestamp"))


def _every(name: str, divisor: int, remainder: int = 0) -> Column:
    return F.col(name) % divisor == remainder


def _cycle(name: str, values: Sequence[str | None]) -> Column:
    """Value by position ``name`` modulo the number of values."""
    position = (F.col(name) % len(values)).cast("int")
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), position)


def pos_feed(lineitem: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Sales lines; returns come in with a negative quantity."""
    returned = F.when(_every("l_partkey", 97), 60).otherwise(0)
    discount = F.when(F.col("l_discount") != 0, F.col("l_extendedprice") * F.col("l_discount"))
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.col("l_suppkey").cast("bigint").alias("store_id"),
        F.col("l_partkey").cast("bigint").alias("product_id"),
        (F.col("l_quantity").cast("int") - returned).alias("quantity"),
        F.col("l_extendedprice").alias("revenue"),
        discount.alias("discount_applied"),
        _epoch("l_shipdate").alias("timestamp"),
        *keep,
    )


def inventory_feed(part: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Stock counts of each product in five warehouses; some were counted a day earlier
    as well (``generation`` 1) under the same id."""
    generations = F.when(_every("p_partkey", 7), F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    counts = part.withColumn("w", F.explode(F.sequence(F.lit(0), F.lit(WAREHOUSES - 1))))
    counts = counts.withColumn("generation", F.explode(generations))
    key, w, g = F.col("p_partkey"), F.col("w"), F.col("generation")
    return counts.select(
        (key.cast("bigint") * WAREHOUSES + w).alias("inventory_id"),
        key.cast("bigint").alias("product_id"),
        w.alias("warehouse_id"),
        ((key * 31 + w * 17 + g * 7) % 60 - 5).cast("int").alias("stock_level"),
        F.when(~_every("p_partkey", 11), F.col("p_size") % 25 - 1).alias("restock_threshold"),
        (F.lit(NEWEST_STOCK_COUNT) + w * 3600 - g * 86_400).cast("bigint").alias("last_updated"),
        *keep,
    )


def _interaction_type() -> Column:
    return (
        F.when(F.col("event_type") == "view", "Inquiry")
        .when(F.col("event_type") == "click", "Loyalty_Action")
        .when(F.col("event_type") == "error", "Complaint")
        .when(F.col("event_type") == "purchase", "Resolution")
        .otherwise("Feedback")
    )


CHANNELS = ("email", "Phone", "chat", None)


def crm_feed(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Customer interactions with times cut to the minute, so that keys repeat."""
    epoch = _epoch("ts")
    return events.select(
        F.col("user_id").cast("bigint").alias("customer_id"),
        _interaction_type().alias("interaction_type"),
        _cycle("event_id", CHANNELS).alias("channel"),
        F.when(~_every("event_id", 6, 5), (F.col("event_id") * 7 % 8).cast("int")).alias("rating"),
        F.when(~_every("event_id", 5), F.col("props")).alias("message_excerpt"),
        (epoch - epoch % 60).alias("timestamp"),
        *keep,
    )


def wtl_feed(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Web traffic; one event in twenty is logged twice with another page."""
    copies = F.when(_every("event_id", 20), F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    logged = events.withColumn("copy", F.explode(copies))
    event_type = (
        F.when(_every("event_id", 13), None)
        .when(F.col("event_type") == "view", "page_view")
        .when(F.col("event_type") == "error", "bounce")
        .otherwise(F.col("event_type"))
    )
    return logged.select(
        F.concat_ws("-", "user_id", F.to_date("ts")).alias("session_id"),
        F.when(~_every("event_id", 10), F.col("user_id").cast("bigint")).alias("user_id"),
        F.concat(F.lit("/p/"), (F.col("event_id") + F.col("copy")) % 50).alias("page"),
        _cycle("event_id", ("mobile", "DESKTOP", "tablet", None)).alias("device_type"),
        _cycle("event_id", ("chrome", "Firefox", "SAFARI", "edge", None)).alias("browser"),
        event_type.alias("event_type"),
        _epoch("ts").alias("timestamp"),
        *keep,
    )


def live_records(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Interactions as JSON text in ``value``, the way senders write them: ratings as
    text, now and then unusable; sometimes no time, or no type at all."""
    rating = (
        F.when(_every("event_id", 6, 5), None)
        .when(_every("event_id", 9, 4), "bad")
        .otherwise((F.col("event_id") * 7 % 8).cast("string"))
    )
    fields = {
        "customer_id": F.col("user_id"),
        "interaction_type": _interaction_type(),
        "channel": _cycle("event_id", CHANNELS),
        "rating": rating,
        "message_excerpt": F.when(~_every("event_id", 5), F.col("props")),
        "timestamp": F.when(~_every("event_id", 19), _epoch("ts")),
    }

    def written(without: str | None = None) -> Column:
        chosen = [v.alias(k) for k, v in fields.items() if k != without]
        return F.to_json(F.struct(*chosen), {"ignoreNullFields": "false"})

    text = F.when(_every("event_id", 17, 3), written(without="interaction_type")).otherwise(written())
    # The one-element explode keeps later filters from repeating the whole expression.
    return events.select(F.explode_outer(F.array(text)).alias("value"), *keep)


def live_web_records(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Web traffic as JSON text in ``value``; some records name no page, some break off."""
    carried = list(dict.fromkeys([*keep, "event_id"]))
    hits = wtl_feed(events, carried)
    fields = [c for c in hits.columns if c not in carried]

    def written(names: Sequence[str]) -> Column:
        return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})

    whole = written(fields)
    text = (
        F.when(_every("event_id", 23, 5), written([c for c in fields if c != "page"]))
        .when(_every("event_id", 31, 2), F.expr("left(to_json(struct(session_id, page)), 12)"))
        .otherwise(whole)
    )
    return hits.select(F.explode_outer(F.array(text)).alias("value"), *keep)


NOT_UTF8 = "//79"  # base64 of the bytes FF FE FD


def live_envelopes(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The same records in base64 envelopes (``data``), some empty or damaged."""
    text = F.col("value")
    sent = (
        F.when(_every("event_id", 37), "")
        .when(_every("event_id", 29), F.concat(F.lit("@@"), encode(text)))
        .when(_every("event_id", 41), NOT_UTF8)
        .when(_every("event_id", 31), encode(F.expr("left(value, length(value) - 1)")))
        .otherwise(encode(text))
    )
    carried = list(dict.fromkeys([*keep, "event_id"]))
    records = live_records(events, carried)
    return records.select(F.explode_outer(F.array(sent)).alias("data"), *keep)
