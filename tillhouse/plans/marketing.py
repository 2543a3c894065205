"""Web session rates, engagement, marketing mart, click-through."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.columns import ratio, share_of_rows
from tillhouse.plans.periods import Period, within
from tillhouse.schemas import BOUNCE, CLICK, LOYALTY_ACTION, PAGE_VIEW


def web_session_rates(wtl: DataFrame) -> DataFrame:
    """Shares of page views and bounces in each session, and their quotient.

    Type names are compared in upper case, which is how silver stores them.
    """
    return (
        wtl.groupBy("session_id", "user_id")
        .agg(
            share_of_rows(F.col("event_type") == PAGE_VIEW).alias("page_views"),
            share_of_rows(F.col("event_type") == BOUNCE).alias("bounces"),
        )
        .withColumn("avg_session_duration", F.lit(0.0))
        .withColumn("bounce_rate", ratio(F.col("bounces"), F.col("page_views")))
    )


def crm_engagement(crm: DataFrame) -> DataFrame:
    """Mean rating with "not rated" as 0, loyalty actions and all interactions."""
    return crm.groupBy("customer_id").agg(
        F.avg(F.coalesce("rating", F.lit(0))).alias("engagement_score"),
        F.count_if(F.col("interaction_type") == LOYALTY_ACTION).alias("loyalty_actions"),
        F.count("*").alias("total_interactions"),
    )


def _web_per_user(wtl: DataFrame, measured_sessions: bool) -> DataFrame:
    views = F.count_if(F.col("event_type") == PAGE_VIEW)
    bounces = F.count_if(F.col("event_type") == BOUNCE)
    known = wtl.where(F.col("user_id").isNotNull())
    if not measured_sessions:
        per_user = known.groupBy("user_id").agg(
            views.alias("page_views"),
            bounces.alias("bounces"),
            F.lit(0.0).alias("avg_session_duration"),
        )
    else:
        second = F.unix_seconds("timestamp")
        per_user = (
            known.groupBy("user_id", "session_id")
            .agg(
                views.alias("page_views"),
                bounces.alias("bounces"),
                (F.max(second) - F.min(second)).alias("duration"),
            )
            .groupBy("user_id")
            .agg(
                F.sum("page_views").alias("page_views"),
                F.sum("bounces").alias("bounces"),
                F.coalesce(F.avg("duration"), F.lit(0.0)).alias("avg_session_duration"),
            )
        )
    return per_user.select(
        F.col("user_id").alias("customer_id"),
        "avg_session_duration",
        ratio(F.col("bounces"), F.col("page_views")).alias("bounce_rate"),
    )


def marketing_mart(
    wtl: DataFrame,
    crm: DataFrame,
    processing_date: dt.date,
    period: Period | None = None,
    measured_sessions: bool = False,
) -> DataFrame:
    """One row per customer with both web sessions and interactions.

    The bounce rate is taken over all rows of the customer instead of one arbitrary
    session. ``avg_session_duration`` is 0.0 unless ``measured_sessions`` asks for the
    mean length of the customer's sessions in seconds.
    """
    web = _web_per_user(within(wtl, period), measured_sessions)
    engagement = crm_engagement(within(crm, period))
    return web.join(engagement, "customer_id").select(
        "customer_id",
        "engagement_score",
        "avg_session_duration",
        "bounce_rate",
        ratio(F.col("loyalty_actions"), F.col("total_interactions")).alias("loyalty_activity_rate"),
        "loyalty_actions",
        F.lit(processing_date).alias("date"),
    )


def click_through_daily(wtl: DataFrame) -> DataFrame:
    """Clicks, page views and their quotient per day."""
    return (
        wtl.groupBy("date")
        .agg(
            F.count_if(F.col("event_type") == CLICK).alias("clicks"),
            F.count_if(F.col("event_type") == PAGE_VIEW).alias("page_views"),
        )
        .withColumn("click_through_rate", ratio(F.col("clicks"), F.col("page_views")))
    )
