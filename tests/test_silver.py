"""Silver rules on hand-written rows."""

import datetime as dt
import hashlib

import pytest
from conftest import epoch
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillhouse import schemas as S
from tillhouse.plans import silver
from tillhouse.plans.silver import CRM, INVENTORY, POS, TABLES, WTL

NOON = epoch(2024, 5, 8, 12)


def pos_rows(spark, *rows):
    return spark.createDataFrame(rows, S.BRONZE_POS)


def test_pos_checks_and_money(spark, rows):
    bronze = pos_rows(
        spark,
        ("ok", 1, 2, 3, 10.0, 1.5, NOON),
        ("no-discount", 1, 2, 0, 0.0, None, NOON),
        ("big-discount", 1, 2, 1, 1.0, 4.0, NOON),
        ("negative-quantity", 1, 2, -1, 1.0, None, NOON),
        ("negative-revenue", 1, 2, 1, -0.01, None, NOON),
        ("no-quantity", 1, 2, None, 1.0, None, NOON),
        ("no-revenue", 1, 2, 1, None, None, NOON),
    )
    result = silver.silver_pos(bronze)
    assert result.schema.names == S.SILVER_POS.names
    assert [f.dataType for f in result.schema] == [f.dataType for f in S.SILVER_POS]
    assert rows(result, "transaction_id", "discount_applied", "net_revenue") == [
        ("big-discount", 4.0, -3.0),
        ("no-discount", 0.0, 0.0),
        ("ok", 1.5, 8.5),
    ]
    assert rows(silver.rejects(bronze, POS), "transaction_id", "reject_reason") == [
        ("negative-quantity", "bad_quantity"),
        ("negative-revenue", "bad_revenue"),
        ("no-quantity", "bad_quantity"),
        ("no-revenue", "bad_revenue"),
    ]


def test_pos_partition_is_the_day_of_the_sale(spark, rows):
    last_second = epoch(2024, 2, 29, 23, 59, 59)
    result = silver.silver_pos(
        pos_rows(spark, ("a", 1, 1, 1, 1.0, None, last_second), ("b", 1, 1, 1, 1.0, None, last_second + 1))
    )
    assert rows(result, "transaction_id", "date", "year", "month", "day") == [
        ("a", dt.date(2024, 2, 29), 2024, 2, 29),
        ("b", dt.date(2024, 3, 1), 2024, 3, 1),
    ]


def test_newest_copy_survives_and_hides_an_older_good_one(spark, rows):
    bronze = pos_rows(
        spark,
        ("t", 1, 1, 1, 1.0, None, NOON),
        ("t", 1, 1, 5, 2.0, None, NOON + 1),
        ("u", 1, 1, 1, 1.0, None, NOON),
        ("u", 1, 1, -5, 2.0, None, NOON + 1),
        ("v", 1, 1, 1, 1.0, None, None),
        ("v", 1, 1, 2, 1.0, None, NOON),
    )
    assert rows(silver.silver_pos(bronze), "transaction_id", "quantity") == [("t", 5), ("v", 2)]


def test_bad_text_becomes_null_instead_of_an_error(spark, rows):
    bronze = spark.createDataFrame(
        [("a", "1", "x", "2", "3.5", None, "oops"), ("b", "1", "1", "two", "1", None, str(NOON)),
         ("c", "1", "1", "2", "3.5", "oops", str(NOON))],
        "transaction_id string, store_id string, product_id string, quantity string,"
        " revenue string, discount_applied string, timestamp string",
    )
    result = silver.silver_pos(bronze)
    assert rows(result, "transaction_id", "store_id", "product_id", "net_revenue", "timestamp") == [
        ("a", 1, None, 3.5, None)
    ]
    assert rows(silver.rejects(bronze, POS), "transaction_id", "reject_reason") == [
        ("b", "bad_quantity"), ("c", "bad_discount")
    ]


def test_epoch_fraction_is_dropped_and_absurd_epoch_is_null(spark, rows):
    bronze = spark.createDataFrame(
        [("a", 1, 1, 1, 1.0, None, NOON + 0.7), ("b", 1, 1, 1, 1.0, None, 9e18)],
        "transaction_id string, store_id int, product_id int, quantity int, revenue double,"
        " discount_applied double, timestamp double",
    )
    stamped = silver.silver_pos(bronze).select("transaction_id", F.unix_millis("timestamp"))
    assert rows(stamped) == [("a", NOON * 1000), ("b", None)]


def test_inventory_rules(spark, rows):
    bronze = spark.createDataFrame(
        [
            (1, 1, 1, 5, 5, NOON),
            (2, 1, 2, 6, 5, NOON),
            (3, 1, 3, 0, None, NOON),
            (4, 1, 4, -1, 5, NOON),
            (5, 1, 5, None, 5, NOON),
            (6, 1, 6, 5, -1, NOON),
        ],
        S.BRONZE_INVENTORY,
    )
    result = silver.silver_inventory(bronze)
    assert rows(result, "inventory_id", "restock_threshold", "needs_restock", "hour") == [
        (1, 5, True, 12),
        (2, 5, False, 12),
        (3, 0, True, 12),
    ]
    assert rows(silver.rejects(bronze, INVENTORY), "inventory_id", "reject_reason") == [
        (4, "bad_stock_level"),
        (5, "bad_stock_level"),
        (6, "bad_restock_threshold"),
    ]


def test_inventory_id_is_required_in_any_letter_case(spark, rows):
    bronze = spark.createDataFrame([(1, 1, 1, 5, 5, NOON)], S.BRONZE_INVENTORY)
    upper = bronze.withColumnRenamed("inventory_id", "INVENTORY_ID")
    assert rows(silver.silver_inventory(upper), "inventory_id") == [(1,)]
    with pytest.raises(ValueError, match="inventory_id"):
        silver.silver_inventory(bronze.drop("inventory_id"))


def test_crm_ratings_types_and_hash(spark, rows):
    bronze = spark.createDataFrame(
        [
            (1, "Feedback", "Phone", 0, "x", NOON),
            (2, "Feedback", "Phone", 1, "x", NOON),
            (3, "resolution", None, 5, None, NOON),
            (4, "Feedback", "chat", 6, "x", NOON),
            (5, None, "chat", None, "", NOON),
        ],
        S.BRONZE_CRM,
    )

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    result = silver.silver_crm(bronze)
    assert rows(result, "customer_id", "interaction_type", "channel", "rating", "message_excerpt") == [
        (2, "FEEDBACK", "PHONE", 1, digest("x")),
        (3, "RESOLUTION", "UNKNOWN", 5, ""),
        (5, None, "CHAT", None, digest("")),
    ]


def test_crm_rating_as_text(spark, rows):
    bronze = spark.createDataFrame(
        [(1, "a", "b", "4", "m", NOON), (2, "a", "b", "bad", "m", NOON), (3, "a", "b", "9", "m", NOON)],
        "customer_id int, interaction_type string, channel string, rating string,"
        " message_excerpt string, timestamp long",
    )
    assert rows(silver.silver_crm(bronze), "customer_id", "rating") == [(1, 4), (2, None)]


def test_wtl_case_anonymous_and_hash(spark, rows):
    bronze = spark.createDataFrame(
        [
            ("s", 7, "/", "mobile-web PHONE", "FIREFOX", "page_view", NOON),
            ("s", None, "/", None, None, None, NOON + 1),
            ("s", 7, "/", "mobile-web PHONE", "FIREFOX", "page_view", NOON),
        ],
        S.BRONZE_WTL,
    )
    result = silver.silver_wtl(bronze)
    assert rows(result, "device_type", "browser", "event_type", "hashed_user_id", "is_anonymous") == [
        ("Mobile-web Phone", "Firefox", "PAGE_VIEW", hashlib.sha256(b"7").hexdigest(), False),
        ("UNKNOWN", "UNKNOWN", "UNKNOWN", None, True),
    ]


def test_null_keys_form_one_group(spark):
    bronze = spark.createDataFrame([(None, "/", NOON), (None, "/", NOON)], "session_id string, page string, timestamp long")
    padded = bronze.selectExpr(
        "session_id", "1 AS user_id", "page", "'a' AS device_type", "'b' AS browser",
        "'c' AS event_type", "timestamp",
    )
    assert silver.silver_wtl(padded).count() == 1


def test_rows_whose_key_cannot_be_typed_are_set_aside(spark, rows):
    bronze = spark.createDataFrame(
        [("1", "a", str(NOON)), ("x", "b", str(NOON)), (None, "c", str(NOON)), ("1", "d", "soon")],
        "customer_id string, interaction_type string, timestamp string",
    ).selectExpr("*", "'p' AS channel", "'3' AS rating", "'m' AS message_excerpt")
    assert rows(silver.keyless(bronze, CRM), "interaction_type", "reject_reason") == [
        ("b", "null_key"), ("c", "null_key"), ("d", "null_key"),
    ]


POS_ROW = st.tuples(
    st.sampled_from(["a", "b", "c", None]),
    st.integers(1, 2),
    st.integers(1, 3),
    st.sampled_from([-1, 0, 1, None]),
    st.sampled_from([-0.01, 0.0, 2.5, None]),
    st.sampled_from([None, 0.5]),
    st.sampled_from([NOON, NOON + 1, None]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(POS_ROW, min_size=1, max_size=12), st.randoms(use_true_random=False))
def test_order_of_arrival_does_not_matter_and_no_row_is_lost(spark, rows, data, random):
    shuffled = random.sample(data, len(data))
    straight, mixed = pos_rows(spark, *data), pos_rows(spark, *shuffled).repartition(3)
    good, refused = silver.silver_pos(straight), silver.rejects(straight, POS)
    assert rows(good) == rows(silver.silver_pos(mixed))
    assert rows(refused) == rows(silver.rejects(mixed, POS))
    copies = len(data) - len({row[0] for row in data})
    assert good.count() + refused.count() + copies == len(data)


@pytest.mark.parametrize("table", TABLES.values(), ids=list(TABLES))
def test_empty_feed_gives_an_empty_table_of_the_schema(spark, table):
    result = silver.refine(spark.createDataFrame([], table.bronze), table)
    assert result.count() == 0
    assert [(f.name, f.dataType) for f in result.schema] == [(f.name, f.dataType) for f in table.schema]


def test_partition_columns_come_from_the_key_where_that_is_claimed():
    assert {t.name for t in TABLES.values() if t.key_fixes_partition} == {CRM.name, WTL.name}
    for table in (CRM, WTL):
        assert table.time_column in table.keys
