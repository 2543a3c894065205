"""Event-time results with a bound on lateness.

All three emit a group once the watermark has passed it (append mode), keep state only
for groups that are still open, and collapse rows inside the map tasks before the
shuffle. Rows later than the bound are dropped by Spark; the sink of the same feed in
batch form remains the full record. The groups that are still open when a stream stops are
computed from the stored records (``with_open_windows``, ``with_open_sessions``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.operators.timelines import gap_sessions


def volume_windows(
    interactions: DataFrame, width: str = "10 minutes", lateness: str = "10 minutes"
) -> DataFrame:
    """Interactions of each type in tumbling windows."""
    return (
        interactions.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", width).alias("span"), "interaction_type")
        .agg(F.count("*").alias("volume"))
        .select(
            F.col("span.start").alias("window_start"),
            F.col("span.end").alias("window_end"),
            "interaction_type",
            "volume",
        )
    )


def one_per_key(
    records: DataFrame, keys: tuple[str, ...] = ("session_id",), lateness: str = "10 minutes"
) -> DataFrame:
    """One record per key and event time, the one with the greatest other values.

    Copies that come within the lateness bound count as one. The survivor does not
    depend on the order of arrival, at the price of being emitted when the watermark
    passes it rather than at once. A copy that comes later than the bound is dropped.
    """
    others = [c for c in records.columns if c not in (*keys, "timestamp")]
    return (
        records.withWatermark("timestamp", lateness)
        .groupBy(*keys, "timestamp")
        .agg(F.max(F.struct(*others)).alias("_survivor"))
        .select(*keys, "timestamp", "_survivor.*")
    )


def web_sessions(
    events: DataFrame,
    owner: str = "user_id",
    gap: str = "30 minutes",
    lateness: str = "10 minutes",
) -> DataFrame:
    """Sessions of each owner that ended by inactivity.

    Only first and last event and a count are kept per open session. Rows without an
    owner belong to nobody and form no session.
    """
    return (
        events.where(F.col(owner).isNotNull())
        .withWatermark("timestamp", lateness)
        .groupBy(owner, F.session_window("timestamp", gap).alias("span"))
        .agg(F.count("*").alias("events"))
        .select(
            owner,
            F.col("span.start").alias("session_start"),
            (F.col("span.end") - F.expr(f"INTERVAL {gap}")).alias("session_end"),
            "events",
        )
    )


def _at(watermark: str | None) -> Column:
    return F.lit(watermark or "0001-01-01T00:00:00Z").cast("timestamp")


def with_open_windows(
    closed: DataFrame, interactions: DataFrame, watermark: str | None, width: str = "10 minutes"
) -> DataFrame:
    """The closed windows of a stream and those its watermark has not passed, these from the
    stored records. Only records that may lie in an open window are read."""
    recent = interactions.where(F.col("timestamp") >= _at(watermark) - F.expr(f"INTERVAL {width}"))
    still_open = (
        recent.groupBy(F.window("timestamp", width).alias("span"), "interaction_type")
        .agg(F.count("*").alias("volume"))
        .where(F.col("span.end") > _at(watermark))
    )
    return closed.unionByName(
        still_open.select(
            F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"),
            "interaction_type", "volume",
        )
    )


def with_open_sessions(
    closed: DataFrame, events: DataFrame, owner: str = "user_id", gap_minutes: int = 30
) -> DataFrame:
    """The closed sessions of a stream and the open ones: those of the stored records that
    come after the last closed session of their owner."""
    last = closed.groupBy(owner).agg(F.max("session_end").alias("closed_until"))
    later = events.join(last, owner, "left").where(
        F.col("closed_until").isNull() | (F.col("timestamp") > F.col("closed_until"))
    )
    return closed.unionByName(gap_sessions(later, owner, gap_minutes))
