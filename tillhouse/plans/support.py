"""Customer support metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.columns import holds, moment, number, ratio, type_counts_json
from tillhouse.operators.timelines import resolution_totals
from tillhouse.schemas import COMPLAINT, FEEDBACK, LOYALTY_ACTION, RESOLUTION


def feedback_score(crm: DataFrame) -> DataFrame:
    """Mean rating of Feedback interactions as one metric row; null when there is none."""
    rated = crm.where(F.col("interaction_type") == FEEDBACK)
    return rated.agg(F.avg("rating").alias("value")).select(
        F.lit("average_feedback_score").alias("metric_name"), "value"
    )


def interaction_volume(crm: DataFrame) -> DataFrame:
    """Interactions of each type, in type order."""
    return (
        crm.groupBy("interaction_type")
        .agg(F.count("*").alias("volume"))
        .orderBy("interaction_type")
    )


def feedback_trend(crm: DataFrame) -> DataFrame:
    """Feedback score and number of ratings per day."""
    return (
        crm.where(F.col("interaction_type") == FEEDBACK)
        .groupBy("date")
        .agg(F.avg("rating").alias("feedback_score"), F.count("rating").alias("ratings"))
    )


def time_to_resolution(crm: DataFrame) -> DataFrame:
    """Mean minutes between a Resolution and the customer's previous interaction,
    one row; 0 when no Resolution has a previous interaction."""
    totals = resolution_totals(crm).agg(
        F.sum("resolved").alias("resolved"),
        F.sum("resolution_seconds").alias("resolution_seconds"),
    )
    return totals.select(
        ratio(F.col("resolution_seconds"), F.col("resolved"), unit=60).alias(
            "avg_time_to_resolution_minutes"
        ),
        F.coalesce("resolved", F.lit(0)).alias("resolutions"),
    )


def daily_support_mart(history: DataFrame, day: dt.date) -> DataFrame:
    """Support mart of one day. ``history`` holds that day and the days before; of these
    only the customers with a Resolution on the day are read."""
    today = history.where(F.col("date") == F.lit(day))
    resolved = today.where(F.col("interaction_type") == RESOLUTION).select("customer_id")
    earlier = history.where(F.col("date") < F.lit(day)).join(
        resolved.distinct(), "customer_id", "left_semi"
    )
    return customer_support_mart(earlier.unionByName(today), day, day)


def customer_support_mart(
    crm: DataFrame, processing_date: dt.date, day: dt.date | None = None
) -> DataFrame:
    """Ratings, interaction counts and resolution time of each customer.

    The time is null for a customer without a Resolution that follows something.
    Interactions without a customer or a time do not count. With ``day`` the row tells
    of that day, with the time since interactions of earlier days.
    """

    def of_type(name: str) -> Column:
        return holds(F.col("interaction_type") == name).cast("int")

    totals = resolution_totals(
        crm,
        extra={
            "rating_sum": F.col("rating"),
            "rated": F.col("rating").isNotNull().cast("int"),
            "complaint_count": of_type(COMPLAINT),
            "feedback_count": of_type(FEEDBACK),
            "loyalty_count": of_type(LOYALTY_ACTION),
        },
        day=day,
    )
    return totals.select(
        "customer_id",
        ratio(F.col("rating_sum"), F.col("rated"), otherwise=None).alias("avg_rating"),
        "complaint_count",
        "feedback_count",
        "loyalty_count",
        ratio(F.col("resolution_seconds"), F.col("resolved"), otherwise=None, unit=3600).alias(
            "avg_resolution_hours"
        ),
        F.lit(processing_date).alias("date"),
    )


def _truthy(name: str) -> Column:
    """Present, not empty and not zero, whether the sender wrote text or a number."""
    text = F.col(name).cast("string")
    return holds((text != "") & (F.coalesce(text.try_cast("double"), F.lit(1.0)) != 0))


def support_records(live: DataFrame, stamp: str) -> DataFrame:
    """Live records with a customer, typed; ``is_clean`` tells those that count."""
    rating = number("rating", "double")
    at = moment("timestamp")
    return live.where(_truthy("customer_id")).select(
        stamp,
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("interaction_type").cast("string").alias("interaction_type"),
        rating.alias("rating"),
        at.alias("timestamp"),
        (at.isNotNull() & (rating.isNull() | rating.between(1, 5))).alias("is_clean"),
    )


def type_volumes(records: DataFrame, stamp: str) -> DataFrame:
    """Interactions of each type in each batch, one row each, however many types there are."""
    counted = records.where("is_clean AND interaction_type IS NOT NULL")
    return counted.groupBy(stamp, "interaction_type").agg(F.count("*").alias("volume"))


def volumes_as_json(volumes: DataFrame, stamp: str) -> DataFrame:
    """View of the volumes as one JSON text per batch, for readers that want it."""
    listed = F.collect_list(F.struct("interaction_type", "volume"))
    return volumes.groupBy(stamp).agg(type_counts_json(listed).alias("interaction_volume_by_type"))


def batch_figures(records: DataFrame, stamp: str, known: DataFrame) -> DataFrame:
    """Score and time to resolution of each batch. The time counts from the customer's
    previous interaction, in the batch or before it: ``known`` holds the second of the last
    one before (``customer_id``, ``known_second`` and the batch)."""
    clean = F.col("is_clean")
    rated = records.groupBy(stamp).agg(
        F.sum(F.when(clean, F.col("rating"))).alias("rating_sum"),
        F.count(F.when(clean, F.col("rating"))).alias("rated"),
    )
    resolutions = resolution_totals(records.where(clean), (stamp, "customer_id"), before=known)
    parts = rated.unionByName(
        resolutions.groupBy(stamp).agg(
            F.sum("resolved").alias("resolved"),
            F.sum("resolution_seconds").alias("resolution_seconds"),
        ),
        allowMissingColumns=True,
    )
    sums = [F.sum(c).alias(c) for c in ("rating_sum", "rated", "resolved", "resolution_seconds")]
    return parts.groupBy(stamp).agg(*sums).select(
        stamp,
        ratio(F.col("rating_sum"), F.col("rated")).alias("feedback_score"),
        ratio(F.col("resolution_seconds"), F.col("resolved"), unit=60).alias(
            "avg_time_to_resolution_minutes"
        ),
    )


def support_snapshot(live: DataFrame, stamp: str = "kpi_date") -> DataFrame:
    """One row of support figures per batch of live interactions.

    ``live`` holds raw records (fields may be text) and a column ``stamp`` that names
    the batch; batches know nothing of each other. Records without a customer are
    ignored, and a batch of only such records yields no row. Records without a time
    or with a rating outside 1..5 are cleaned away; a batch emptied by that yields
    zeros and ``{}``. The score is the mean of all ratings. Types are reported as sent.
    The JSON object has one entry per type, so its size is the number of types.
    """
    records = support_records(live, stamp)
    clean = F.col("is_clean")
    by_type = records.groupBy(stamp, "interaction_type").agg(
        F.count_if(clean).alias("volume"),
        F.sum(F.when(clean, F.col("rating"))).alias("rating_sum"),
        F.count(F.when(clean, F.col("rating"))).alias("rated"),
    )
    resolutions = (
        resolution_totals(records.where(clean), owner=(stamp, "customer_id"))
        .groupBy(stamp)
        .agg(
            F.sum("resolved").alias("resolved"),
            F.sum("resolution_seconds").alias("resolution_seconds"),
        )
    )
    # Both parts are a few rows per batch; stacked and summed they need no join.
    parts = by_type.unionByName(resolutions, allowMissingColumns=True)
    shown = F.col("interaction_type").isNotNull() & (F.col("volume") > 0)
    figures = parts.groupBy(stamp).agg(
        F.sum("rating_sum").alias("rating_sum"),
        F.sum("rated").alias("rated"),
        F.collect_list(F.when(shown, F.struct("interaction_type", "volume"))).alias("volumes"),
        F.sum("resolved").alias("resolved"),
        F.sum("resolution_seconds").alias("resolution_seconds"),
    )
    return figures.select(
        ratio(F.col("rating_sum"), F.col("rated")).alias("feedback_score"),
        type_counts_json(F.col("volumes")).alias("interaction_volume_by_type"),
        ratio(F.col("resolution_seconds"), F.col("resolved"), unit=60).alias(
            "avg_time_to_resolution_minutes"
        ),
        stamp,
    )
