"""Timelines against brute force, with one owner holding a third of the rows."""

import datetime as dt
import random

import pytest
from conftest import epoch
from pyspark.sql import functions as F

from tillhouse.operators.timelines import gap_sessions, resolution_totals
from tillhouse.plans import support

START = epoch(2024, 2, 27)
TYPES = ["Feedback", "Resolution", "resolution", "Complaint", None]


def history(seed, size=600, days=4):
    """Random events of ten owners; owner 0 has a third of them, some share a second."""
    rng = random.Random(seed)
    events = []
    for _ in range(size):
        owner = 0 if rng.random() < 1 / 3 else rng.randint(1, 9)
        second = START + rng.randrange(days * 86_400) // rng.choice([1, 1, 600]) * 1
        if rng.random() < 0.3:
            second = START + rng.randrange(days) * 86_400 + rng.choice([0, 1, 86_399])
        events.append((owner, rng.choice(TYPES), second))
    return events


def frame(spark, events):
    raw = spark.createDataFrame(events, "customer_id int, interaction_type string, second long")
    return raw.withColumn("timestamp", F.timestamp_seconds("second")).repartition(5)


def brute_force_resolutions(events):
    totals = {}
    for owner in {e[0] for e in events}:
        line = sorted(
            (second, (kind or "").upper() == "RESOLUTION")
            for o, kind, second in events
            if o == owner
        )
        waits = [
            line[i][0] - line[i - 1][0] for i in range(1, len(line)) if line[i][1]
        ]
        totals[owner] = (len(waits), sum(waits))
    return totals


@pytest.mark.parametrize("seed", range(4))
def test_resolution_totals_equal_brute_force(spark, seed):
    events = history(seed)
    found = resolution_totals(frame(spark, events)).collect()
    assert {
        r.customer_id: (r.resolved, r.resolution_seconds) for r in found
    } == brute_force_resolutions(events)


def test_rows_without_owner_or_time_take_no_part(spark):
    events = [(1, "Complaint", START), (1, "Resolution", START + 60), (None, "Resolution", START + 90), (1, "Resolution", None)]
    found = resolution_totals(frame(spark, events)).collect()
    assert [(r.customer_id, r.resolved, r.resolution_seconds) for r in found] == [(1, 1, 60)]


@pytest.mark.parametrize(
    ("events", "minutes", "resolutions"),
    [
        ([(1, "Resolution", START)], 0.0, 0),
        ([(1, "Complaint", START), (1, "Feedback", START + 5)], 0.0, 0),
        ([(1, "Complaint", START), (1, "Resolution", START)], 0.0, 1),
        ([(1, "Complaint", START), (1, "Resolution", START + 90)], 1.5, 1),
        ([(1, "Resolution", START), (1, "Resolution", START + 86_400 * 3)], 4320.0, 1),
        ([(1, "Complaint", START), (2, "Resolution", START + 90)], 0.0, 0),
    ],
)
def test_time_to_resolution(spark, events, minutes, resolutions):
    row = support.time_to_resolution(frame(spark, events)).first()
    assert (row.avg_time_to_resolution_minutes, row.resolutions) == (minutes, resolutions)


def test_time_to_resolution_of_nothing_is_zero(spark):
    row = support.time_to_resolution(frame(spark, [(1, "Resolution", START)]).limit(0)).first()
    assert (row.avg_time_to_resolution_minutes, row.resolutions) == (0.0, 0)


def brute_force_sessions(events, gap):
    found = []
    for owner in {e[0] for e in events}:
        seconds = sorted(second for o, _, second in events if o == owner)
        current = [seconds[0], seconds[0], 0]
        for second in seconds:
            if second - current[1] > gap:
                found.append((owner, *current))
                current = [second, second, 0]
            current[1] = second
            current[2] += 1
        found.append((owner, *current))
    return sorted(found)


@pytest.mark.parametrize("seed", range(4))
def test_sessions_equal_brute_force(spark, seed):
    events = history(seed, days=3)
    found = gap_sessions(frame(spark, events), "customer_id", gap_minutes=30).select(
        "customer_id", F.unix_seconds("session_start"), F.unix_seconds("session_end"), "events"
    )
    assert sorted(tuple(r) for r in found.collect()) == brute_force_sessions(events, 1800)


def test_session_goes_on_over_midnight_and_at_the_exact_gap(spark):
    midnight = epoch(2024, 3, 1)
    seconds = [midnight - 900, midnight + 900, midnight + 2701]
    found = gap_sessions(frame(spark, [(1, None, s) for s in seconds]), "customer_id").collect()
    assert sorted((r.session_start, r.events) for r in found) == [
        (dt.datetime(2024, 2, 29, 23, 45), 2),
        (dt.datetime(2024, 3, 1, 0, 45, 1), 1),
    ]


def test_batch_sessions_equal_session_window(spark):
    events = frame(spark, history(9)).select(F.col("customer_id").alias("user_id"), "timestamp")
    ours = gap_sessions(events)
    sparks = (
        events.groupBy("user_id", F.session_window("timestamp", "30 minutes").alias("w"))
        .agg(F.count("*").alias("events"))
        .select(
            "user_id",
            F.col("w.start").alias("session_start"),
            (F.col("w.end") - F.expr("INTERVAL 30 minutes")).alias("session_end"),
            "events",
        )
    )
    assert ours.exceptAll(sparks).count() == sparks.exceptAll(ours).count() == 0


def test_the_first_window_is_over_one_day_of_an_owner(spark):
    """Raw seconds are sorted within (owner, day); only day summaries within an owner."""
    events = frame(spark, history(1))
    for result in (resolution_totals(events), gap_sessions(events, "customer_id")):
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window [" in line]
        deepest = windows[-1].rsplit("], [", 2)[1]
        assert len(windows) >= 2
        assert "customer_id" in deepest and "day" in deepest
