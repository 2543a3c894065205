"""Layer jobs end to end, run twice."""

import datetime as dt
from pathlib import Path

import pytest
from conftest import epoch

from tillhouse import jobs
from tillhouse import schemas as S
from tillhouse.plans.silver import CRM, INVENTORY, POS, WTL
from tillhouse.sinks import tables as sink
from tillhouse.sinks.reports import read_mart

DATE = dt.date(2024, 5, 8)
NOON = epoch(2024, 5, 8, 12)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = jobs.Lake(str(tmp_path_factory.mktemp("lake")))
    feeds = [
        (POS, S.BRONZE_POS, [("a", 1, 1, 2, 10.0, None, NOON), ("b", 1, 1, -2, 1.0, None, NOON), (None, 1, 1, 1, 1.0, None, NOON)]),
        (INVENTORY, S.BRONZE_INVENTORY, [(1, 1, 1, 4, 5, NOON), (2, 1, 2, -4, 5, NOON)]),
        (CRM, S.BRONZE_CRM, [(1, "Complaint", None, 4, "m", NOON), (1, "Resolution", None, None, "m", NOON + 7200), (2, "Feedback", None, 9, "m", NOON)]),
        (WTL, S.BRONZE_WTL, [("s", 1, "/", None, None, "page_view", NOON)]),
    ]
    for _ in range(2):
        for table, schema, rows in feeds:
            jobs.refresh_silver(spark, lake, spark.createDataFrame(rows, schema), table, DATE)
        jobs.refresh_sales(spark, lake, DATE)
        jobs.refresh_marketing(spark, lake, DATE)
        jobs.refresh_operations(spark, lake, DATE)
        jobs.refresh_support(spark, lake, DATE)
    return lake


def mart(spark, lake, contract):
    frame = read_mart(spark, lake.mart(contract), contract)
    return [tuple(r) for r in frame.select(*contract.schema.names).collect()]


def test_marts_hold_one_run(spark, lake):
    assert mart(spark, lake, S.SALES_MART) == [(1, 1, 10.0, 2, 4, True, 0.5, DATE)]
    assert [r[0] for r in mart(spark, lake, S.MARKETING_MART)] == [1]
    assert [r[:1] + r[2:4] for r in mart(spark, lake, S.OPERATIONS_MART)] == [(1, 1, "MEDIUM")]
    assert [(r[0], float(r[1]), r[2], float(r[5])) for r in mart(spark, lake, S.SUPPORT_MART)] == [
        (1, 4.0, 1, 2.0)
    ]


def test_rows_that_keep_their_keys_are_deduplicated_and_stored_once(
    spark, folder, rows, monkeypatch
):
    monkeypatch.setattr(sink, "keep_newest", None)
    lake = jobs.Lake(folder)
    for sold in ([("a", 1, 1, 2, 10.0, None, NOON), ("a", 1, 1, 3, 9.0, None, NOON + 60),
                  ("b", 1, 1, -2, 1.0, None, NOON)], [("b", 1, 1, 4, 1.0, None, NOON)]):
        jobs.refresh_silver(spark, lake, spark.createDataFrame(sold, S.BRONZE_POS), POS, DATE)
    kept = jobs.read_silver(spark, lake, POS)
    assert rows(kept, "transaction_id", "quantity") == [("a", 3), ("b", 4)]


def test_keys_that_typing_makes_one_are_deduplicated_once_more(spark, folder, rows):
    counts = spark.createDataFrame(
        [("1", 1, 1, 4, 5, NOON), ("01", 1, 1, 6, 5, NOON + 60), ("2", 1, 1, 7, 5, NOON)],
        "inventory_id string, product_id bigint, warehouse_id int, stock_level int, "
        "restock_threshold int, last_updated bigint",
    )
    lake = jobs.Lake(folder)
    jobs.refresh_silver(spark, lake, counts, INVENTORY, DATE)
    kept = jobs.read_silver(spark, lake, INVENTORY)
    assert rows(kept, "inventory_id", "stock_level") == [(1, 6), (2, 7)]


def test_refused_rows_lie_outside_the_tables(spark, lake):
    def reasons(table):
        found = jobs.read_rejects(spark, lake, table).where("year = 2024 AND day = 8")
        return sorted(r.reject_reason for r in found.collect())

    assert reasons(POS) == ["bad_quantity", "null_key"]
    assert reasons(INVENTORY) == ["bad_stock_level"]
    assert reasons(CRM) == ["rating_out_of_range"]
    assert not lake.rejected.startswith(lake.silver(POS))


def test_every_row_without_key_is_kept_and_runs_stay_apart(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    first = [(None, 1, i, 1, float(i), None, NOON) for i in range(10)]
    first += [("a", 1, 1, 1, 1.0, None, NOON)] * 2
    second = [("b", 1, 1, -1, 1.0, None, NOON)]
    for run, rows in (("10", first), ("11", second), ("10", first)):
        bronze = spark.createDataFrame(rows, S.BRONZE_POS)
        jobs.refresh_silver(spark, lake, bronze, POS, DATE, run)
    found = jobs.read_rejects(spark, lake, POS).collect()
    assert sorted(r.product_id for r in found if r.run == "10") == list("0123456789")
    assert [r.reject_reason for r in found if r.run == "11"] == ["bad_quantity"]
    assert [r.transaction_id for r in jobs.read_silver(spark, lake, POS).collect()] == ["a"]


def test_resolution_of_the_next_day_counts_on_that_day(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    contacts = [(1, "Complaint", None, 4, "m", NOON), (1, "Resolution", None, None, "m", NOON + 86_400),
                (2, "Feedback", None, 5, "m", NOON)]
    bronze = spark.createDataFrame(contacts, S.BRONZE_CRM)
    jobs.refresh_silver(spark, lake, bronze, CRM, DATE)
    jobs.refresh_support(spark, lake, DATE + dt.timedelta(days=1))
    assert [(r[0], r[2], float(r[5])) for r in mart(spark, lake, S.SUPPORT_MART)] == [(1, 0, 24.0)]


def test_ids_beyond_int(spark, tmp_path):
    lake, big = jobs.Lake(str(tmp_path)), 2**31 + 7
    rows = [(big, big, 1, 4, 5, NOON)]
    jobs.refresh_silver(
        spark, lake, spark.createDataFrame(rows, S.BRONZE_INVENTORY), INVENTORY, DATE
    )
    stored = jobs.read_silver(spark, lake, INVENTORY).first()
    assert (stored.inventory_id, stored.product_id) == (big, big)


def test_gold_files_of_every_metric(lake):
    found = {p.parent.parent.parent.parent.name for p in Path(lake.gold).rglob("_SUCCESS")}
    assert found == {
        "sales_mart", "marketing_mart", "operations_mart", "customer_support_mart",
        "inventory_turnover", "restock_frequency", "stockout_alerts", "feedback_score",
        "interaction_volume",
    }


def test_absent_silver_table_is_an_empty_typed_frame(spark, tmp_path):
    empty = jobs.read_silver(spark, jobs.Lake(str(tmp_path)), POS)
    assert empty.count() == 0
    assert empty.schema == S.SILVER_POS


def test_purge_rewrites_only_partitions_that_lose_rows(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    contacts = [
        (customer, "Feedback", None, 4, "m", NOON + 86_400 * days)
        for customer, days in ((1, 0), (2, 0), (1, 1), (3, 2), (2, -90))
    ]
    jobs.refresh_silver(spark, lake, spark.createDataFrame(contacts, S.BRONZE_CRM), CRM, DATE)
    untouched = next(Path(lake.silver(CRM)).rglob("day=10/*.parquet"))
    stamp = untouched.stat().st_mtime_ns
    forgotten = spark.createDataFrame([(1,)], "customer_id bigint")
    for _ in range(2):
        jobs.purge_users(spark, lake, CRM, DATE, 30, forgotten, "customer_id")
        left = jobs.read_silver(spark, lake, CRM).collect()
        assert sorted((r.customer_id, r.day) for r in left) == [(2, 8), (3, 10)]
    assert untouched.stat().st_mtime_ns == stamp


def test_purge_opens_only_folders_of_forgotten_users_and_old_ones(spark, tmp_path, monkeypatch):
    lake = jobs.Lake(str(tmp_path))
    contacts = [
        (customer, "Feedback", None, 4, "m", NOON + 86_400 * days)
        for customer, days in ((1, 0), (2, 1), (3, 2), (2, 3), (4, -90))
    ]
    jobs.refresh_silver(spark, lake, spark.createDataFrame(contacts, S.BRONZE_CRM), CRM, DATE)
    opened = []
    remove = sink.remove_rows
    monkeypatch.setattr(sink, "remove_rows", lambda *a: opened.append(a[4]) or remove(*a))
    forgotten = spark.createDataFrame([(1,), (99,)], "customer_id bigint")
    jobs.purge_users(spark, lake, CRM, DATE, 30, forgotten, "customer_id")
    assert opened == [{"year=2024/month=5/day=8", "year=2024/month=2/day=8"}]
    left = jobs.read_silver(spark, lake, CRM).collect()
    assert sorted((r.customer_id, r.day) for r in left) == [(2, 9), (2, 11), (3, 10)]


def test_support_history_opens_only_folders_of_resolved_customers(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    contacts = [(1, "Complaint", None, 4, "m", NOON), (2, "Complaint", None, 4, "m", NOON + 86_400),
                (1, "Resolution", None, None, "m", NOON + 3 * 86_400)]
    jobs.refresh_silver(spark, lake, spark.createDataFrame(contacts, S.BRONZE_CRM), CRM, DATE)
    history = jobs.support_history(spark, lake, DATE + dt.timedelta(days=3))
    assert {f.split("day=")[1].split("/")[0] for f in history.inputFiles()} == {"8", "11"}
    assert history.count() == 2
