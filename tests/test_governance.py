"""Team views, hashing, retention, profile."""

import datetime as dt
import hashlib

import pytest

from tillhouse import schemas as S
from tillhouse.operators import governance
from tillhouse.operators.profiling import profile, row_counts
from tillhouse.plans.silver import TABLES

NOW = dt.datetime(2024, 5, 8, 12)


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [(f"t{s}", s, 1, 1, 1.0, 0.0, 1.0, NOW, NOW.date(), 2024, 5, 8) for s in (102, 103, 104)],
        S.SILVER_POS,
    )


def test_team_sees_its_columns_and_rows(spark, sales, rows):
    view = governance.team_view(sales, "operations", "pos", row_filter="store_id = 103")
    assert view.columns == ["store_id", "product_id", "quantity", "date"]
    assert rows(view, "store_id") == [(103,)]
    allowed = spark.createDataFrame([(103,), (104,), (104,)], "store_id int")
    assert rows(governance.team_view(sales, "sales", "pos", allowed=allowed), "store_id") == [(103,), (104,)]


def test_support_sees_filtered_interactions(spark, rows):
    contacts = spark.createDataFrame(
        [(c, t, "EMAIL", 1, "", NOW, NOW.date(), 2024, 5, 8, 12) for c, t in ((1, "FEEDBACK"), (2, "LOYALTY_ACTION"))],
        S.SILVER_CRM,
    )
    assert rows(governance.team_view(contacts, "support", "customer_interaction"), "customer_id") == [(1,)]


def test_marketing_sees_salted_digests_only(spark, rows):
    visit = ("s", 5, "plain", "/", "Tv", "X", "CLICK", NOW, NOW.date(), False, 2024, 5, 8, 12)
    visits = spark.createDataFrame([visit], S.SILVER_WTL)
    with pytest.raises(ValueError, match="salt"):
        governance.team_view(visits, "marketing", "wtl")
    view = governance.team_view(visits, "marketing", "wtl", salt="pepper")
    assert rows(view, "hashed_user_id") == [(hashlib.sha256(b"pepper5").hexdigest(),)]


def test_other_teams_have_no_access(sales):
    with pytest.raises(PermissionError):
        governance.team_view(sales, "marketing", "pos")


def test_views_name_existing_columns_and_no_raw_user_id():
    for (_, table), view in governance.TEAM_VIEWS.items():
        assert set(view.columns) <= set(TABLES[table].schema.names)
        assert not {"user_id", "message_excerpt"} & set(view.columns)


def test_hash_is_salted_and_the_id_is_gone(spark, rows):
    frame = spark.createDataFrame([(7,), (None,)], "user_id int")
    hashed = governance.hash_users(frame, "salt")
    assert hashed.columns == ["hashed_user_id"]
    assert rows(hashed) == [(hashlib.sha256(b"salt7").hexdigest(),), (None,)]


def test_retention(spark, rows):
    frame = spark.createDataFrame(
        [(1, NOW.date()), (2, dt.date(2024, 4, 8)), (3, dt.date(2024, 4, 7)), (4, None), (5, NOW.date()), (None, NOW.date())],
        "customer_id int, date date",
    )
    forgotten = spark.createDataFrame([(5,), (5,)], "customer_id int")
    kept = governance.retain(frame, NOW.date(), 30, forgotten)
    assert rows(kept, "customer_id") == [(1,), (2,), (4,), (None,)]
    assert governance.retain(frame, NOW.date(), 30).count() == 5


def test_profile_counts_nulls_types_and_copies(spark):
    live = spark.createDataFrame(
        [("1", "x", "5"), ("1", "x", "bad"), (None, None, None), ("one", "y", "2")],
        "customer_id string, interaction_type string, rating string",
    )
    expected = S.struct_of(customer_id=S.INT, interaction_type=S.TEXT, rating=S.INT)
    found = {
        r.column_name: (r.nulls, r.type_mismatches, r.row_count, r.surplus_copies)
        for r in profile(live, expected, ["customer_id", "interaction_type"]).collect()
    }
    assert found == {
        "customer_id": (1, 1, 4, 1), "interaction_type": (1, 0, 4, 1), "rating": (1, 1, 4, 1),
    }


def test_profile_of_nothing(spark):
    empty = spark.createDataFrame([], "a string")
    assert [tuple(r) for r in profile(empty, S.struct_of(a=S.INT), ["a"]).collect()] == [("a", 0, 0, 0, 0)]


def test_row_counts(spark):
    frame = spark.range(3)
    assert [tuple(r) for r in row_counts({"in": frame, "out": frame.limit(1)}).collect()] == [("in", 3), ("out", 1)]
