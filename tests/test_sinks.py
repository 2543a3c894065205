"""Upsert, landing, CSV and marts on disk."""

import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillhouse import schemas as S
from tillhouse.operators.merging import merge_frames
from tillhouse.plans.periods import Period
from tillhouse.plans.silver import CRM, INVENTORY, POS
from tillhouse.sinks import key_index, landing, reports, versions
from tillhouse.sinks import tables as sink
from tillhouse.sources.tables import read_partition_folder, read_table, register_folder

DAY = dt.datetime(2024, 5, 8, 12)
NEXT = dt.datetime(2024, 5, 9, 12)
LATER = dt.datetime(2024, 5, 10, 12)


def stock(spark, *records):
    rows = [
        (i, 1, 1, level, 0, False, at, at and at.year, at and at.month, at and at.day, at and at.hour)
        for i, level, at in records
    ]
    return spark.createDataFrame(rows, S.SILVER_INVENTORY)


def stored(spark, path, rows):
    return rows(read_table(spark, path, S.SILVER_INVENTORY), "inventory_id", "stock_level", "day")


def test_merge_frames_updates_and_adds(spark, rows):
    old = stock(spark, (1, 5, DAY), (2, 6, DAY))
    new = stock(spark, (2, 9, NEXT), (3, 7, NEXT))
    assert rows(merge_frames(old, new, ["inventory_id"]), "inventory_id", "stock_level") == [
        (1, 5), (2, 9), (3, 7),
    ]


def test_upsert_creates_updates_moves_and_is_idempotent(spark, folder, rows):
    path = f"{folder}/inventory"
    sink.upsert(spark, path, stock(spark, (1, 5, DAY), (2, 6, DAY), (3, 8, NEXT)), INVENTORY)
    assert stored(spark, path, rows) == [(1, 5, 8), (2, 6, 8), (3, 8, 9)]
    update = stock(spark, (2, 9, NEXT), (4, 1, NEXT))
    for _ in range(2):
        sink.upsert(spark, path, update, INVENTORY)
        assert stored(spark, path, rows) == [(1, 5, 8), (2, 9, 9), (3, 8, 9), (4, 1, 9)]


def test_partition_that_lost_its_rows_is_removed(spark, folder, rows):
    path = f"{folder}/inventory"
    sink.upsert(spark, path, stock(spark, (1, 5, DAY), (2, 6, DAY)), INVENTORY)
    sink.upsert(spark, path, stock(spark, (1, 7, NEXT), (2, 8, NEXT)), INVENTORY)
    assert stored(spark, path, rows) == [(1, 7, 9), (2, 8, 9)]
    assert list(versions.current(spark, path)) == ["year=2024/month=5/day=9"]


def test_rows_without_a_time_live_in_the_null_partition(spark, folder, rows):
    path = f"{folder}/inventory"
    sink.upsert(spark, path, stock(spark, (1, 5, None), (2, 6, DAY)), INVENTORY)
    sink.upsert(spark, path, stock(spark, (1, 7, DAY), (3, 8, None)), INVENTORY)
    assert stored(spark, path, rows) == [(1, 7, 8), (2, 6, 8), (3, 8, None)]
    sink.upsert(spark, path, stock(spark, (3, 9, DAY)), INVENTORY)
    assert stored(spark, path, rows) == [(1, 7, 8), (2, 6, 8), (3, 9, 8)]


def test_untouched_partitions_keep_their_files(spark, folder):
    path = f"{folder}/inventory"
    sink.upsert(spark, path, stock(spark, (1, 5, DAY), (2, 6, NEXT)), INVENTORY)
    before = {p: p.stat().st_mtime_ns for p in Path(path).rglob("day=8/*.parquet")}
    sink.upsert(spark, path, stock(spark, (2, 7, NEXT)), INVENTORY)
    after = {p: p.stat().st_mtime_ns for p in Path(path).rglob("day=8/*.parquet")}
    assert before and before == after


def test_null_keys_are_left_out(spark, folder, rows):
    path = f"{folder}/inventory"
    update = stock(spark, (None, 5, DAY), (1, 6, DAY))
    for _ in range(2):
        sink.upsert(spark, path, update, INVENTORY)
    assert stored(spark, path, rows) == [(1, 6, 8)]


def test_empty_update_changes_nothing(spark, folder, rows):
    path = f"{folder}/inventory"
    sink.upsert(spark, path, stock(spark, (1, 5, DAY)), INVENTORY)
    sink.upsert(spark, path, stock(spark), INVENTORY)
    assert stored(spark, path, rows) == [(1, 5, 8)]


def test_failed_merge_is_raised_and_leaves_the_table(spark, folder, rows):
    path = f"{folder}/inventory"
    sink.upsert(spark, path, stock(spark, (1, 5, DAY)), INVENTORY)
    bad = stock(spark, (1, 6, DAY)).selectExpr(
        "inventory_id", "product_id", "warehouse_id",
        "CAST(raise_error('boom') AS INT) AS stock_level", "restock_threshold", "needs_restock",
        "last_updated", "year", "month", "day", "hour",
    )
    with pytest.raises(PySparkException):
        sink.upsert(spark, path, bad, INVENTORY)
    with pytest.raises(ValueError, match="columns"):
        sink.upsert(spark, path, stock(spark, (1, 6, DAY)).drop("hour"), INVENTORY)
    assert stored(spark, path, rows) == [(1, 5, 8)]


@pytest.mark.parametrize("dies_in", ["write_partitioned", "commit"])
def test_interrupted_change_is_invisible(spark, folder, rows, monkeypatch, dies_in):
    path = f"{folder}/inventory"
    sink.upsert(spark, path, stock(spark, (1, 5, DAY), (2, 6, DAY)), INVENTORY)

    def dies(*arguments, **options):
        raise KeyboardInterrupt

    with monkeypatch.context() as crash:
        crash.setattr(sink if dies_in == "write_partitioned" else versions, dies_in, dies)
        with pytest.raises(KeyboardInterrupt):
            sink.upsert(spark, path, stock(spark, (1, 7, NEXT), (2, 8, LATER)), INVENTORY)
    assert stored(spark, path, rows) == [(1, 5, 8), (2, 6, 8)]
    sink.upsert(spark, path, stock(spark, (1, 9, NEXT), (3, 1, NEXT)), INVENTORY)
    assert stored(spark, path, rows) == [(1, 9, 9), (2, 6, 8), (3, 1, 9)]


def test_index_that_missed_a_change_catches_up(spark, folder, rows, monkeypatch):
    path = f"{folder}/inventory"
    sink.upsert(spark, path, stock(spark, (1, 5, DAY), (2, 6, DAY)), INVENTORY)

    def dies(*arguments, **options):
        raise KeyboardInterrupt

    with monkeypatch.context() as crash:
        crash.setattr(key_index, "append", dies)
        with pytest.raises(KeyboardInterrupt):
            sink.upsert(spark, path, stock(spark, (1, 7, NEXT)), INVENTORY)
    assert stored(spark, path, rows) == [(1, 7, 9), (2, 6, 8)]  # committed already
    sink.upsert(spark, path, stock(spark, (1, 8, LATER)), INVENTORY)
    assert stored(spark, path, rows) == [(1, 8, 10), (2, 6, 8)]


def test_index_survives_a_catalog_that_forgot_it_and_a_rebuild(spark, folder, rows):
    path = f"{folder}/inventory"
    sink.upsert(spark, path, stock(spark, (1, 5, DAY), (2, 6, NEXT)), INVENTORY)
    name = key_index.table_of(spark, path, S.SILVER_INVENTORY, INVENTORY.keys)
    spark.sql(f"DROP TABLE {name}")
    sink.upsert(spark, path, stock(spark, (1, 7, LATER)), INVENTORY)
    assert stored(spark, path, rows) == [(1, 7, 10), (2, 6, 9)]
    key_index.rebuild(spark, path, S.SILVER_INVENTORY, INVENTORY.keys)
    assert rows(spark.table(name), "inventory_id", "folder") == [
        (1, "year=2024/month=5/day=10"), (2, "year=2024/month=5/day=9"),
    ]
    sink.upsert(spark, path, stock(spark, (2, 8, LATER)), INVENTORY)
    assert stored(spark, path, rows) == [(1, 7, 10), (2, 8, 10)]


def test_lookup_does_not_move_the_index(spark, folder):
    path = f"{folder}/inventory"
    sink.upsert(spark, path, stock(spark, *[(i, 5, DAY) for i in range(50)]), INVENTORY)
    wanted = stock(spark, (1, 7, NEXT)).repartition(3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = key_index.whereabouts(spark, path, wanted, S.SILVER_INVENTORY, INVENTORY.keys)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The one exchange by key is that of the update.
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("FileScan") < plan.index("Exchange hashpartitioning")


def test_old_versions_are_removed_later(spark, folder, rows):
    path = f"{folder}/inventory"
    for level in range(5):
        sink.upsert(spark, path, stock(spark, (1, level, DAY), (10 + level, 1, NEXT)), INVENTORY)
    reader = read_table(spark, path, S.SILVER_INVENTORY)
    versions.remove_old(spark, path, INVENTORY.partitions)
    assert sorted(p.name for p in Path(f"{path}/data").iterdir()) == ["version=4", "version=5"]
    assert sorted(p.name for p in Path(f"{path}/current").iterdir()) == ["version=4", "version=5"]
    assert rows(reader, "inventory_id", "stock_level")[0] == (1, 4)


def test_half_written_version_is_ignored(spark, folder, rows):
    path = f"{folder}/inventory"
    sink.upsert(spark, path, stock(spark, (1, 5, DAY)), INVENTORY)
    stock(spark, (1, 99, DAY)).write.parquet(f"{path}/data/version=2/year=2024/month=5/day=8")
    assert stored(spark, path, rows) == [(1, 5, 8)]
    sink.upsert(spark, path, stock(spark, (2, 6, DAY)), INVENTORY)
    assert stored(spark, path, rows) == [(1, 5, 8), (2, 6, 8)]


def test_crm_upsert_reads_only_the_partitions_of_the_update(spark, folder, rows):
    """The key holds the time, so a row cannot have moved."""
    path = f"{folder}/crm"

    def contact(rating, at):
        return spark.createDataFrame(
            [(1, "FEEDBACK", "EMAIL", rating, "", at, at.date(), at.year, at.month, at.day, at.hour)],
            S.SILVER_CRM,
        )

    sink.upsert(spark, path, contact(1, DAY).unionAll(contact(2, NEXT)), CRM)
    sink.upsert(spark, path, contact(5, NEXT), CRM)
    assert rows(read_table(spark, path, S.SILVER_CRM), "rating", "day") == [(1, 8), (5, 9)]


def test_period_prunes_partitions_of_either_spelling(spark, folder, rows):
    padded = f"{folder}/padded"
    data = stock(spark, (1, 5, DAY)).drop("year", "month", "day")
    data.write.parquet(f"{padded}/year=2024/month=05/day=08")
    read = read_table(spark, padded, S.SILVER_INVENTORY, Period(2024, 5, 8))
    assert rows(read, "inventory_id", "month", "day") == [(1, 5, 8)]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    one = read_partition_folder(spark, padded, "year=2024/month=05/day=08", S.SILVER_INVENTORY)
    assert rows(one, "inventory_id", "day") == [(1, 8)]


def test_catalog_table_finds_new_partitions(spark, folder):
    path = f"{folder}/inventory"
    sink.upsert(spark, path, stock(spark, (1, 5, DAY)), INVENTORY)
    name = register_folder(spark, "default", "bronze_stock_t", path, S.SILVER_INVENTORY, INVENTORY.partitions)
    assert spark.table(name).count() == 1
    sink.upsert(spark, path, stock(spark, (2, 5, NEXT)), INVENTORY)
    register_folder(spark, "default", "bronze_stock_t", path, S.SILVER_INVENTORY, INVENTORY.partitions)
    assert spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")


def test_upsert_joins_and_looks_up_only_where_rows_may_be_replaced(
    spark, folder, rows, monkeypatch
):
    path = f"{folder}/inventory"

    def dies(*_):
        raise AssertionError("needless")

    with monkeypatch.context() as needless:
        for module, name in ((sink, "merge_frames"), (key_index, "whereabouts")):
            needless.setattr(module, name, dies)
        sink.upsert(spark, path, stock(spark, (1, 5, DAY), (2, 6, DAY)), INVENTORY)
    with monkeypatch.context() as needless:
        needless.setattr(key_index, "whereabouts", dies)
        sink.upsert(spark, path, stock(spark, (1, 7, DAY), (3, 8, NEXT)), INVENTORY)
    assert stored(spark, path, rows) == [(1, 7, 8), (2, 6, 8), (3, 8, 9)]
    with monkeypatch.context() as needless:
        needless.setattr(sink, "merge_frames", dies)
        sink.upsert(spark, path, stock(spark, (4, 1, LATER)), INVENTORY)
    sink.upsert(spark, path, stock(spark, (1, 9, LATER)), INVENTORY)
    assert stored(spark, path, rows) == [(1, 9, 10), (2, 6, 8), (3, 8, 9), (4, 1, 10)]


def test_unique_updates_are_not_deduplicated_again(spark, folder, rows, monkeypatch):
    monkeypatch.setattr(sink, "keep_newest", None)
    path, updates = f"{folder}/inventory", f"{folder}/updates"
    sink.upsert(spark, path, stock(spark, (1, 5, DAY), (None, 6, DAY)), INVENTORY, unique=True)
    stock(spark, (1, 7, NEXT), (2, 8, NEXT)).write.parquet(updates)
    written = spark.read.schema(S.SILVER_INVENTORY).parquet(updates)
    sink.upsert(spark, path, written, INVENTORY, unique=True, stored=True)
    assert stored(spark, path, rows) == [(1, 7, 9), (2, 8, 9)]
    assert written.count() == 2


def test_landing_replaces_files_of_the_same_name(spark, folder, rows):
    path = f"{folder}/bronze"

    def file(name, *values):
        return spark.createDataFrame([(v, name) for v in values], "value int, source_file string")

    ten, eleven = dt.datetime(2024, 5, 8, 10, 15), dt.datetime(2024, 5, 8, 11, 5)
    landing.land(spark, file("a.json", 1, 2), path, ten, hourly=True)
    landing.land(spark, file("b.json", 3), path, ten, hourly=True)
    landing.land(spark, file("a.json", 9), path, ten.replace(minute=50), hourly=True)
    landing.land(spark, file("a.json", 9), path, eleven, hourly=True)
    landing.land(spark, file("a.json").limit(0), path, eleven, hourly=True)
    assert rows(spark.read.parquet(path), "value", "source_file", "hour") == [
        (3, "b.json", 10), (9, "a.json", 10), (9, "a.json", 11),
    ]


def test_arrival_is_in_utc(spark, rows):
    frame = spark.createDataFrame([(1,)], "value int")
    east = dt.datetime(2024, 5, 9, 1, 30, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    stamped = landing.with_arrival(frame, east, hourly=True).selectExpr("CAST(ingest_ts AS STRING)", "day", "hour")
    assert rows(stamped) == [("2024-05-08 23:30:00", 8, 23)]


def test_landing_is_written_by_the_tasks_that_scan(spark, folder, rows):
    path, before = f"{folder}/bronze", spark.conf.get(landing.WRITERS)
    values = spark.range(0, 4000, 1, 4).selectExpr("id", "IF(id < 3000, 'a', NULL) AS source_file")
    landing.land(spark, values, path, DAY, hourly=False)
    day = Path(f"{path}/year=2024/month=5/day=8")
    assert len(list(day.glob("source_file=a/*.parquet"))) == 3
    assert spark.read.parquet(path).where("source_file IS NULL").count() == 1000
    assert spark.read.parquet(path).selectExpr("sum(id)").first()[0] == 3999 * 2000
    assert spark.conf.get(landing.WRITERS) == before


def test_landing_of_nothing_creates_nothing(spark, folder):
    empty = spark.createDataFrame([], "value int, source_file string")
    landing.land(spark, empty, f"{folder}/bronze", DAY, hourly=False)
    assert not Path(f"{folder}/bronze").exists()


SALE = (1, 2, 10.5, 3, 4, True, 0.75, DAY.date())


def mart_frame(spark, *values):
    return spark.createDataFrame(values, S.SALES_MART.schema)


def test_csv_is_one_file_in_the_dated_folder(spark, folder):
    frame = mart_frame(spark, SALE, (2, *SALE[1:])).repartition(2)
    path = reports.write_csv(frame, folder, "sales_mart", DAY.date(), single_file=True)
    assert path.endswith("sales_mart/year=2024/month=05/day=08")
    files = list(Path(path).glob("*.csv"))
    assert len(files) == 1
    assert files[0].read_text().splitlines()[0] == ",".join(S.SALES_MART.schema.names)


def test_mart_load_is_typed_positional_and_repeatable(spark, folder, rows):
    renamed = mart_frame(spark, SALE).withColumnRenamed("total_sales", "umsatz")
    path = reports.write_csv(renamed, folder, "sales_mart", DAY.date())
    for _ in range(2):
        reports.load_mart(spark, path, S.SALES_MART, f"{folder}/mart")
    loaded = reports.read_mart(spark, f"{folder}/mart", S.SALES_MART)
    assert rows(loaded, *S.SALES_MART.schema.names) == [SALE]


def test_mart_decimals_are_rounded(spark, folder, rows):
    gold = spark.createDataFrame(
        [(1, 2.125, 7.004, 0.1, 0.2, 3, DAY.date())],
        "customer_id int, engagement_score double, avg_session_duration double,"
        " bounce_rate double, loyalty_activity_rate double, loyalty_actions bigint, date date",
    )
    path = reports.write_csv(gold, folder, "marketing_mart", DAY.date())
    loaded = reports.read_gold(spark, path, S.MARKETING_MART)
    assert rows(loaded, "engagement_score", "avg_session_duration") == [(Decimal("2.13"), Decimal("7.00"))]
    fitted = reports.fit_mart(gold, S.MARKETING_MART)
    assert fitted.schema.simpleString() == S.MARKETING_MART.schema.simpleString()


@pytest.mark.parametrize(
    ("second", "problem"),
    [(SALE, "repeated_key"), ((None, *SALE[1:]), "null_key")],
)
def test_broken_mart_keys_are_refused(spark, folder, rows, second, problem):
    frame = mart_frame(spark, SALE, second)
    assert [r.problem for r in reports.mart_violations(frame, S.SALES_MART).collect()] == [problem]
    path = reports.write_csv(frame, folder, "sales_mart", DAY.date())
    with pytest.raises(ValueError, match=problem):
        reports.load_mart(spark, path, S.SALES_MART, f"{folder}/mart")
    assert not Path(f"{folder}/mart").exists()


def sold_on(spark, folder, *rows):
    frame = spark.createDataFrame(rows, S.SALES_MART.schema)
    return reports.write_csv(frame, folder, "sales_mart", rows[0][-1])


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_value_that_does_not_fit_is_an_error(spark, folder, ansi):
    path = sold_on(spark, folder, (1, 1, 1.0, 1, 1, True, 1.0, dt.date(2024, 5, 8)))
    name = S.SALES_MART.schema.names[4]
    text = spark.read.option("header", True).csv(path).withColumn(name, F.lit("3000000000"))
    text.write.mode("overwrite").option("header", True).csv(f"{folder}/large")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match=name):
            reports.load_mart(spark, f"{folder}/large", S.SALES_MART, f"{folder}/mart")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert not Path(f"{folder}/mart").exists()


def test_interrupted_mart_load_is_invisible(spark, folder, monkeypatch):
    days = [dt.date(2024, 5, d) for d in (8, 9, 10)]
    row = (1, 1, 1.0, 1, 1, True, 1.0)
    first = sold_on(spark, f"{folder}/a", *[(*row, d) for d in days[:2]])
    second = sold_on(spark, f"{folder}/b", (*row, days[2]))

    def stop(*arguments):
        raise OSError("stopped")

    def held():
        return sorted(r.date for r in reports.read_mart(spark, f"{folder}/mart", S.SALES_MART).collect())

    reports.load_mart(spark, second, S.SALES_MART, f"{folder}/mart")
    with monkeypatch.context() as crash:
        crash.setattr(versions, "commit", stop)
        with pytest.raises(OSError):
            reports.load_mart(spark, first, S.SALES_MART, f"{folder}/mart")
    assert held() == days[2:]
    reports.load_mart(spark, first, S.SALES_MART, f"{folder}/mart")
    assert held() == days


def test_mart_contracts_match_the_warehouse_tables():
    assert {m.name: (len(m.schema), m.key) for m in S.MARTS.values()} == {
        "sales_mart": (8, ("product_id", "store_id", "date")),
        "marketing_mart": (7, ("customer_id", "date")),
        "operations_mart": (5, ("product_id", "date")),
        "customer_support_mart": (7, ("customer_id", "date")),
    }


def test_pos_is_searched_for_moved_rows():
    assert not POS.key_fixes_partition


def test_only_touched_partitions_are_read(spark, folder):
    path = f"{folder}/inventory"
    sink.upsert(spark, path, stock(spark, (1, 5, DAY), (2, 6, NEXT)), INVENTORY)
    existing = read_table(spark, path, S.SILVER_INVENTORY)
    touched = sink._listed(existing.where("day = 9"), INVENTORY.partitions)
    affected = versions.read(spark, path, S.SILVER_INVENTORY, only=touched)
    assert affected.count() == 1
    assert all("day=9" in file for file in affected.inputFiles())
    one_day = read_table(spark, path, S.SILVER_INVENTORY, Period(2024, 5, 8))
    assert one_day.count() == 1 and all("day=8" in file for file in one_day.inputFiles())


def test_landing_touches_no_other_file(spark, folder, rows):
    path = f"{folder}/bronze"

    def file(name, *values):
        return spark.createDataFrame([(v, name) for v in values], "value int, source_file string")

    ten = dt.datetime(2024, 5, 8, 10, 15)
    landing.land(spark, file("a b=1.json", 1, 2), path, ten, hourly=True)
    before = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    landing.land(spark, file("7", 3), path, ten, hourly=True)
    landing.land(spark, file("7", 4), path, ten, hourly=True)
    after = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    assert before and before.items() <= after.items()
    assert rows(spark.read.parquet(path), "value", "source_file") == [
        (1, "a b=1.json"), (2, "a b=1.json"), (4, "7"),
    ]


def test_gold_csv_is_a_catalog_table(spark, folder, rows):
    frame = mart_frame(spark, SALE)
    for date in (DAY.date(), NEXT.date()):
        reports.write_csv(frame, folder, "sales_mart", date)
    columns = S.T.StructType([*S.SALES_MART.schema.fields, *S.struct_of(year=S.INT, month=S.INT, day=S.INT).fields])
    name = register_folder(
        spark, "default", "gold_sales_mart_t", f"{folder}/sales_mart", columns,
        ("year", "month", "day"), "csv", {"header": "true"},
    )
    assert rows(spark.table(name).where("day = 9"), *S.SALES_MART.schema.names) == [SALE]
    assert spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")
