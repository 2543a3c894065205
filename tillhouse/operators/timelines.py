"""Per-owner timelines: time since the previous event, and sessions by inactivity gap.

Both need neighbouring events of one owner (a customer, a user). A window over the
owner alone would sort all events of a busy owner in one task. Here the timeline is
cut into UTC days: events of one second collapse first, a window runs inside
(owner, day), each day shrinks to a few rows that know their own edges, and a second
window over those few rows joins the days. A sort group is thus bounded by the
86,400 seconds of a day, and the last one by the days an owner was active, however
many events the owner has.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.functions.columns import holds
from tillhouse.schemas import RESOLUTION

SECONDS_PER_DAY = 86_400


def _day_of(second: Column) -> Column:
    return F.floor(second / SECONDS_PER_DAY)


def resolution_totals(
    interactions: DataFrame,
    owner: Sequence[str] = ("customer_id",),
    extra: dict[str, Column] | None = None,
    day: dt.date | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """Seconds between each Resolution and the owner's previous interaction, summed.

    The previous interaction is of any type. Interactions of one second are ordered
    with the Resolutions last, so a Resolution closes whatever shares its second.
    Rows without owner or timestamp do not take part. Result per owner:
    ``resolved`` (Resolutions with a previous interaction) and ``resolution_seconds``.

    ``extra`` names further sums over the owner's rows, each given as a column that is
    added up; they ride along and spare a second pass over the table.

    With ``day`` only that day's Resolutions and rows are counted (owners without rows on
    it are left out), while the previous interaction may be of any earlier day.

    ``before`` holds the second of the last interaction that is already known of an owner,
    as ``known_second``: it precedes the first of these rows, unless it is later.
    """
    extra = extra or {}
    owner = list(owner)
    is_resolution = holds(F.upper("interaction_type") == RESOLUTION).cast("int")
    rows = interactions.na.drop(subset=[*owner, "timestamp"]).select(
        *owner,
        F.unix_seconds("timestamp").alias("second"),
        is_resolution.alias("is_resolution"),
        *[value.alias(name) for name, value in extra.items()],
    )
    carried = [F.sum(name).alias(name) for name in extra]

    seconds = rows.groupBy(*owner, _day_of(F.col("second")).alias("day"), "second").agg(
        F.min("is_resolution").alias("only_resolutions"),
        F.sum("is_resolution").alias("resolutions"),
        *carried,
    )
    gap_in_day = F.col("second") - F.lag("second").over(
        Window.partitionBy(*owner, "day").orderBy("second")
    )
    # Only the first row of a second has an earlier neighbour at a distance; it is a
    # Resolution exactly when that second holds nothing else.
    counted_gap = F.when(F.col("only_resolutions") == 1, F.col("gap"))
    opens_day = F.col("gap").isNull()
    days = (
        seconds.withColumn("gap", gap_in_day)
        .groupBy(*owner, "day")
        .agg(
            F.min("second").alias("first_second"),
            F.max("second").alias("last_second"),
            F.max(F.when(opens_day, F.col("only_resolutions"))).alias("opens_with_resolution"),
            F.sum("resolutions").alias("resolutions"),
            F.coalesce(F.sum(counted_gap), F.lit(0)).alias("gap_seconds"),
            *carried,
        )
    )
    previous_day_end = F.lag("last_second").over(Window.partitionBy(*owner).orderBy("day"))
    opening = F.col("opens_with_resolution") == 1
    if before is not None:
        days = days.join(before, owner, "left")
        known = F.when(F.col("known_second") <= F.col("first_second"), F.col("known_second"))
        previous_day_end = F.coalesce(previous_day_end, known)
    bridged = days.withColumn("night", F.col("first_second") - previous_day_end)
    if day is not None:
        bridged = bridged.where(F.col("day") == (day - dt.date(1970, 1, 1)).days)
    return bridged.groupBy(*owner).agg(
        F.sum(
            F.col("resolutions")
            - F.when(opening & F.col("night").isNull(), 1).otherwise(0)
        ).alias("resolved"),
        F.sum(
            F.col("gap_seconds")
            + F.when(opening, F.coalesce("night", F.lit(0))).otherwise(0)
        ).alias("resolution_seconds"),
        *carried,
    )


def gap_sessions(
    events: DataFrame, owner: str = "user_id", gap_minutes: int = 30
) -> DataFrame:
    """Sessions of each owner: a new one starts after more than ``gap_minutes`` of rest.

    Columns: owner, ``session_start``, ``session_end`` (last event), ``events``. The
    rule is that of ``session_window``, so the stream form finds the same sessions.
    """
    gap = gap_minutes * 60
    seconds = (
        events.na.drop(subset=[owner, "timestamp"])
        .select(owner, F.unix_seconds("timestamp").alias("second"))
        .groupBy(owner, _day_of(F.col("second")).alias("day"), "second")
        .agg(F.count("*").alias("events"))
    )
    in_day = Window.partitionBy(owner, "day").orderBy("second")
    starts = holds(F.col("second") - F.lag("second").over(in_day) > gap).cast("int")
    pieces = (
        seconds.withColumn("starts", starts)
        .withColumn("piece", F.sum("starts").over(in_day))
        .groupBy(owner, "day", "piece")
        .agg(
            F.min("second").alias("first_second"),
            F.max("second").alias("last_second"),
            F.sum("events").alias("events"),
        )
    )
    # At most 86,400 / gap pieces a day reach this window.
    in_time = Window.partitionBy(owner).orderBy("first_second")
    opens = holds(F.col("first_second") - F.lag("last_second").over(in_time) > gap).cast("int")
    return (
        pieces.withColumn("opens", opens)
        .withColumn("session_no", F.sum("opens").over(in_time))
        .groupBy(owner, "session_no")
        .agg(
            F.timestamp_seconds(F.min("first_second")).alias("session_start"),
            F.timestamp_seconds(F.max("last_second")).alias("session_end"),
            F.sum("events").alias("events"),
        )
        .drop("session_no")
    )
