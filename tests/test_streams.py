"""Streams over files, several micro-batches, against the batch results."""

import datetime as dt
import json
from base64 import b64encode
from pathlib import Path

import pytest
from conftest import epoch
from pyspark.sql import functions as F

from tillhouse import jobs
from tillhouse import schemas as S
from tillhouse.operators.timelines import gap_sessions
from tillhouse.plans import support as plans_support
from tillhouse.plans.silver import WTL
from tillhouse.sources import envelopes, json_files
from tillhouse.streaming import event_time, landing, support

START = epoch(2024, 5, 8, 9)
GOOD = {"customer_id": 1, "interaction_type": "Feedback", "timestamp": START, "rating": "4"}


def envelope(record):
    text = record if isinstance(record, bytes) else json.dumps(record).encode()
    return b64encode(text).decode()


@pytest.mark.parametrize(
    ("data", "outcome"),
    [
        (envelope(GOOD), "valid"),
        (envelope({**GOOD, "customer_id": None}), "valid"),
        (envelope({k: v for k, v in GOOD.items() if k != "timestamp"}), "missing_field"),
        ("", "empty"),
        (None, "empty"),
        ("@@@@", "bad_base64"),
        (envelope(b"\xff\xfe"), "bad_utf8"),
        (envelope(b'{"customer_id": 1,'), "bad_json"),
        (envelope(b"[1]"), "bad_json"),
        (envelope(json.dumps(GOOD).encode() + b" x"), "bad_json"),
    ],
)
def test_envelope_outcomes(spark, data, outcome):
    frame = spark.createDataFrame([(1, data)], "id int, data string")
    row = envelopes.decode_envelopes(frame, S.LIVE_CRM, envelopes.REQUIRED_CRM).first()
    assert row.outcome == outcome
    assert row.interaction_type == ("Feedback" if outcome == "valid" else None)


def test_web_records_need_session_page_and_time(spark):
    record = {"session_id": "s", "page": "/", "timestamp": START}
    frame = spark.createDataFrame(
        [(envelope(record),), (envelope({**record, "user_id": 3}),), (envelope({"page": "/"}),)],
        "data string",
    )
    decoded = envelopes.decode_envelopes(frame, S.LIVE_WTL, envelopes.REQUIRED_WTL)
    assert envelopes.valid_records(decoded).count() == 2
    assert envelopes.refused_records(decoded).first().outcome == "missing_field"


def test_broken_json_lines_are_kept_aside(spark, folder):
    Path(f"{folder}/a.json").write_text(json.dumps({"customer_id": 1}) + "\n{broken\n")
    lines = json_files.read_json_lines(spark, folder, S.BRONZE_CRM, keep_corrupt=True).cache()
    assert sorted((r.customer_id, r.corrupt_record) for r in lines.collect() if r.customer_id) == [(1, None)]
    assert [r.corrupt_record for r in lines.collect() if r.customer_id is None] == ["{broken"]


def test_json_array_file(spark, folder):
    Path(f"{folder}/a.json").write_text('[{"customer_id": 1},\n {"customer_id": 2}]')
    assert json_files.read_json_arrays(spark, folder, S.BRONZE_CRM).count() == 2


def feed(spark, path, batches, schema):
    """One file per batch, older files first."""
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(path)
        for file in Path(path).glob("part-*.json"):
            if not (renamed := file.parent / f"batch-{number}.json").exists():
                file.rename(renamed)
    return landing.stream_files(spark, path, schema, files_per_batch=1)


def test_landing_into_hourly_gzip_folders(spark, folder):
    records = [[(json.dumps(GOOD),), (json.dumps({"x": 1}),)], [("{",)]]
    schema = S.struct_of(value=S.TEXT)
    stream = landing.screen(feed(spark, f"{folder}/in", records, schema), envelopes.REQUIRED_CRM)
    at = F.timestamp_seconds(F.coalesce(F.get_json_object("value", "$.timestamp").cast("bigint"), F.lit(0)))
    hourly = landing.with_arrival_hour(landing.with_partition_key(stream, "customer_id"), at)
    landing.run_until_caught_up(hourly.where("accepted"), f"{folder}/good", f"{folder}/c1")
    landing.run_until_caught_up(hourly.where("NOT accepted"), f"{folder}/bad", f"{folder}/c2")
    files = list(Path(f"{folder}/good").rglob("*.json.gz"))
    assert [f.parent.relative_to(f"{folder}/good").as_posix() for f in files] == [
        "year=2024/month=5/day=8/hour=9"
    ]
    good = json_files.read_json_lines(spark, f"{folder}/good", hourly.schema)
    assert [(r.partition_key, r.hour) for r in good.collect()] == [("1", 9)]
    assert json_files.read_json_lines(spark, f"{folder}/bad", hourly.schema).count() == 2


def test_restarted_landing_repeats_nothing(spark, folder):
    schema = S.struct_of(value=S.TEXT)
    stream = feed(spark, f"{folder}/in", [[("1",)], [("2",)]], schema)
    for _ in range(2):
        landing.run_until_caught_up(
            stream, f"{folder}/out", f"{folder}/c", file_format="parquet", partitions=()
        )
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_support_figures_per_micro_batch(spark, folder):
    def contact(kind, second, customer=1):
        return (envelope({**GOOD, "interaction_type": kind, "timestamp": second, "customer_id": customer}),)

    batches = [
        [contact("Complaint", START), contact("Resolution", START + 120)],
        [contact("Resolution", START + 600), ("",)],
        [contact("Feedback", START + 700, customer=0)],
    ]
    schema = S.struct_of(data=S.TEXT)
    stream = feed(spark, f"{folder}/in", batches, schema)
    landed, store = f"{folder}/landed", f"{folder}/figures"
    support.start_live_landing(
        stream, landed, f"{folder}/c", trigger=landing.UNTIL_CAUGHT_UP
    ).awaitTermination()
    today = spark.read.parquet(landed).agg(F.max(support.BATCH_DAY)).first()[0]
    for day in (None, today, None):
        support.store_batch_figures(spark, landed, store, day)
    figures = spark.read.parquet(store).orderBy("batch_time").collect()
    assert [r.interaction_volume_by_type for r in figures] == [
        '{"Complaint":1,"Resolution":1}', '{"Resolution":1}',
    ]
    # The second Resolution does not see the first batch.
    assert [r.avg_time_to_resolution_minutes for r in figures] == [2.0, 0.0]


CRM_STREAM = S.struct_of(interaction_type=S.TEXT, user_id=S.INT, second=S.LONG)


def timed(stream):
    return stream.withColumn("timestamp", F.timestamp_seconds("second")).drop("second")


BATCHES = [
    [("A", 1, START), ("A", 1, START + 60), ("B", 2, START + 1200)],
    # The watermark passed the first window with the batch before; Spark still takes rows
    # that come in the very next batch, and drops those of later ones.
    [("A", 1, START + 30), ("B", 2, START + 1210)],
    [("A", 1, START + 30)],
    [("A", 9, START + 90_000)],
]


def run(spark, folder, result):
    landing.run_until_caught_up(
        result, f"{folder}/out", f"{folder}/c", file_format="parquet", partitions=()
    )
    return spark.read.parquet(f"{folder}/out")


def test_windows_drop_only_what_is_later_than_the_watermark(spark, folder):
    stream = timed(feed(spark, f"{folder}/in", BATCHES, CRM_STREAM))
    found = run(spark, folder, event_time.volume_windows(stream))
    start = dt.datetime(2024, 5, 8, 9)
    assert sorted((r.window_start, r.interaction_type, r.volume) for r in found.collect()) == [
        (start, "A", 3), (start + dt.timedelta(minutes=20), "B", 2),
    ]


def test_one_per_key_is_deterministic_within_the_bound(spark, folder):
    batches = [
        [("x", 1, START), ("z", 1, START), ("y", 1, START)],
        [("zz", 1, START), ("a", 2, START + 300)],
        [("late", 9, START + 90_000)],
    ]
    stream = timed(feed(spark, f"{folder}/in", batches, CRM_STREAM))
    found = run(spark, folder, event_time.one_per_key(stream, ("user_id",)))
    assert sorted((r.user_id, r.interaction_type) for r in found.collect()) == [(1, "zz"), (2, "a")]


def test_stream_sessions_equal_batch_sessions(spark, folder):
    seconds = [0, 600, 2399, 2400, 4201, 90_000]
    batches = [[("A", 1, START + s)] for s in seconds] + [[("A", None, START + 95_000), ("A", 5, START + 200_000)]]
    stream = timed(feed(spark, f"{folder}/in", batches, CRM_STREAM))
    found = run(spark, folder, event_time.web_sessions(stream))
    raw = spark.createDataFrame([row for batch in batches for row in batch], CRM_STREAM)
    closed = gap_sessions(timed(raw)).where("user_id = 1")
    assert found.exceptAll(closed).count() == closed.exceptAll(found).count() == 0
    assert closed.count() == 3


def contact(kind, second, customer=1, **more):
    return (envelope({**GOOD, "interaction_type": kind, "timestamp": second, "customer_id": customer, **more}),)


def store_of(spark, folder, batches):
    stream = feed(spark, f"{folder}/in", batches, S.struct_of(data=S.TEXT))
    support.start_live_landing(
        stream, f"{folder}/landed", f"{folder}/c", trigger=landing.UNTIL_CAUGHT_UP
    ).awaitTermination()
    return support.BatchStore(spark, f"{folder}/store"), spark.read.parquet(f"{folder}/landed")


ARRIVING = [
    [contact("Complaint", START), contact("Complaint", START, customer=2)],
    [contact("Feedback", START + 60)],
    [contact("Resolution", START + 600), contact("Resolution", START + 7200, customer=2)],
    [contact("Resolution", START + 30, customer=3), contact("Resolution", START - 60)],
]


@pytest.mark.parametrize("most_deltas", [60, 2])
def test_resolution_in_a_later_batch(spark, folder, monkeypatch, most_deltas):
    monkeypatch.setattr(support, "MOST_DELTAS", most_deltas)
    store, landed = store_of(spark, folder, ARRIVING)
    for _ in range(2):
        store.add(landed)
    figures = store.read("figures").orderBy("version").collect()
    # Nine and 120 minutes; the last batch knows nothing earlier of either customer.
    assert [r.avg_time_to_resolution_minutes for r in figures] == [0.0, 0.0, 64.5, 0.0]
    assert store.read("volumes").where("interaction_type = 'Resolution'").count() == 2
    assert len(store.done()) == 4


def test_interrupted_batch_is_computed_again(spark, folder, monkeypatch):
    store, landed = store_of(spark, folder, ARRIVING)

    def dies(*arguments):
        raise KeyboardInterrupt

    with monkeypatch.context() as crash:
        crash.setattr(support, "batch_figures", dies)
        with pytest.raises(KeyboardInterrupt):
            store.add(landed)
    assert store.done() == []
    store.add(landed)
    figures = store.read("figures").orderBy("version").collect()
    assert [r.avg_time_to_resolution_minutes for r in figures] == [0.0, 0.0, 64.5, 0.0]


def test_many_types_of_one_batch_are_rows(spark):
    many = spark.range(100_000).selectExpr(
        "'b' AS kpi_date", "'1' AS customer_id", "concat('type-', id) AS interaction_type",
        "'5' AS rating", f"'{START}' AS timestamp",
    )
    volumes = plans_support.type_volumes(plans_support.support_records(many, "kpi_date"), "kpi_date")
    assert volumes.count() == 100_000 and volumes.agg(F.sum("volume")).first()[0] == 100_000


def test_refused_envelopes_are_stored_by_kind_and_hour(spark, folder):
    sent = [[contact("Complaint", START), ("",), ("@@",)], [(envelope({"customer_id": 1}),), ("//79",)]]
    stream = feed(spark, f"{folder}/in", sent, S.struct_of(data=S.TEXT))
    support.start_envelope_landing(
        stream, f"{folder}/out", f"{folder}/c", trigger=landing.UNTIL_CAUGHT_UP
    ).awaitTermination()
    landed = spark.read.parquet(f"{folder}/out").collect()
    assert sorted((r.outcome, r.raw) for r in landed if r.raw is not None) == sorted(
        [("empty", ""), ("bad_base64", "@@"), ("bad_utf8", "//79"), ("missing_field", envelope({"customer_id": 1}))]
    )
    assert len(landed) == 5
    assert all(p.name.startswith("outcome=") for p in Path(f"{folder}/out").iterdir() if p.name[0] not in "._")


def test_keys_keep_to_one_lane(spark):
    keys = spark.range(2000).selectExpr("CAST(id % 50 AS STRING) AS partition_key", "id")
    lanes = landing.with_lane(keys.unionByName(keys.selectExpr("CAST(NULL AS STRING) AS partition_key", "id")), 8)
    by_key = lanes.groupBy("partition_key").agg(F.count_distinct("lane").alias("lanes"), F.min("lane").alias("lane"))
    found = {r.partition_key: (r.lanes, r.lane) for r in by_key.collect()}
    assert {n for n, _ in found.values()} == {1} and found[None] == (1, 0)
    assert len({lane for _, lane in found.values()}) == 8


def test_late_copy_leaves_one_row_and_merging_again_changes_nothing(spark, folder):
    lake = jobs.Lake(folder)
    schema = S.T.StructType([*S.BRONZE_WTL.fields, S.T.StructField("batch_time", S.LONG)])
    hits = [("s", 1, "/a", None, None, "click", START, 1), ("t", 2, "/b", None, None, "click", START + 9, 1)]
    late = ("s", 1, "/late", None, None, "click", START, 2)
    for rows in (hits, [*hits, late], [*hits, late]):
        jobs.merge_landed(spark, lake, spark.createDataFrame(rows, schema), WTL, "batch_time")
    kept = jobs.read_silver(spark, lake, WTL).collect()
    assert sorted((r.session_id, r.page) for r in kept) == [("s", "/late"), ("t", "/b")]
