"""Gold rules on hand-written silver rows."""

import datetime as dt

import pytest

from tillhouse import schemas as S
from tillhouse.plans import marketing, operations, sales, support
from tillhouse.plans.periods import Period

DAY = dt.date(2024, 5, 8)
NOON = dt.datetime(2024, 5, 8, 12)


def sale(product, store, quantity, revenue, at=NOON, transaction=None, discount=0.0):
    return (
        transaction or f"{product}-{store}-{at}-{quantity}", store, product, quantity, revenue, discount,
        revenue - discount, at, at.date(), at.year, at.month, at.day,
    )


def stock(inventory_id, product, warehouse, level, threshold, at=NOON):
    return (
        inventory_id, product, warehouse, level, threshold, level <= threshold, at,
        at.year, at.month, at.day, at.hour,
    )


def interaction(customer, kind, rating=None, at=NOON):
    return (customer, kind, "EMAIL", rating, "", at, at.date(), at.year, at.month, at.day, at.hour)


def visit(session, user, kind, at=NOON):
    return (
        session, user, None, "/", "Mobile", "Edge", kind, at, at.date(), user is None,
        at.year, at.month, at.day, at.hour,
    )


@pytest.fixture
def pos(spark):
    return lambda *r: spark.createDataFrame(r, S.SILVER_POS)


@pytest.fixture
def inventory(spark):
    return lambda *r: spark.createDataFrame(r, S.SILVER_INVENTORY)


@pytest.fixture
def crm(spark):
    return lambda *r: spark.createDataFrame(r, S.SILVER_CRM)


@pytest.fixture
def wtl(spark):
    return lambda *r: spark.createDataFrame(r, S.SILVER_WTL)


def test_sales_mart_is_keyed_by_product_and_store(pos, inventory, rows):
    sold = pos(sale(1, 1, 2, 10.0), sale(1, 1, 3, 5.0), sale(2, 1, 4, 8.0), sale(9, 1, 1, 1.0))
    stocked = inventory(
        stock(1, 1, 1, 4, 10), stock(2, 1, 2, 10, 10), stock(3, 2, 1, 0, 1),
    )
    mart = sales.sales_mart(sold, stocked, DAY)
    assert mart.columns == S.SALES_MART.schema.names
    # Stock equal to the threshold is not below it; product 9 has no stock record.
    assert rows(mart) == [
        (1, 1, 15.0, 5, 10, False, 0.5, DAY),
        (2, 1, 8.0, 4, 0, True, 0.0, DAY),
    ]


def test_sales_periods_are_parameters(pos, inventory, rows):
    sold = pos(sale(1, 1, 2, 10.0), sale(1, 1, 3, 5.0, at=dt.datetime(2024, 5, 7, 9)))
    stocked = inventory(stock(1, 1, 1, 4, 1), stock(2, 1, 2, 9, 1, at=dt.datetime(2024, 4, 7)))
    mart = sales.sales_mart(sold, stocked, DAY, Period.day_of(DAY), Period.month_of(DAY))
    assert rows(mart, "total_units", "stock_availability") == [(2, 4)]


def test_sales_by_store_names_the_earliest_product(pos, inventory, rows):
    early = dt.datetime(2024, 5, 1)
    sold = pos(
        sale(3, 1, 1, 1.0), sale(2, 1, 1, 1.0, at=early, transaction="b"),
        sale(1, 1, 1, 1.0, at=early, transaction="a"),
    )
    mart = sales.sales_by_store(sold, inventory(stock(1, 1, 1, 6, 1)), DAY)
    assert rows(mart, "product_id", "store_id", "total_units", "product_turnover_rate") == [
        (1, 1, 3, 0.5)
    ]


def test_revenue_reports(pos, rows):
    sold = pos(sale(1, 1, 2, 10.0, discount=1.0), sale(1, 2, 1, 5.0, at=dt.datetime(2024, 5, 9)))
    assert rows(sales.daily_net_sales(sold), "date", "net_sales", "units") == [
        (DAY, 9.0, 2), (dt.date(2024, 5, 9), 5.0, 1),
    ]
    assert rows(sales.store_revenue(sold), "store_id", "discounts") == [(1, 1.0), (2, 0.0)]


def test_inventory_turnover(pos, inventory, rows):
    sold = pos(sale(1, 1, 6, 1.0), sale(2, 1, 1, 1.0), sale(3, 1, 1, 1.0), sale(1, 1, 9, 1.0, at=dt.datetime(2024, 5, 9)))
    stocked = inventory(
        stock(1, 1, 1, 1, 0), stock(2, 1, 2, 3, 0), stock(3, 2, 1, 0, 0), stock(4, 8, 1, 5, 0)
    )
    result = operations.inventory_turnover(sold, stocked, DAY)
    assert rows(result) == [(1, 3.0), (2, None), (3, None)]


def test_restock_counts_the_threshold_itself_and_stockout_only_zero(inventory, rows):
    stocked = inventory(
        stock(1, 1, 1, 5, 5), stock(2, 1, 1, 4, 5), stock(3, 1, 2, 6, 5), stock(4, 2, 1, 0, 0)
    )
    assert rows(operations.restock_frequency(stocked)) == [(1, 1, 2), (2, 1, 1)]
    assert rows(operations.stockout_alerts(stocked, DAY)) == [(2, 1, 1)]
    assert rows(operations.stockout_alerts(stocked, dt.date(2024, 5, 9))) == []


def test_operations_mart(pos, inventory, rows):
    sold = pos(sale(1, 1, 6, 1.0), sale(7, 1, 6, 1.0))
    stocked = inventory(
        stock(1, 1, 1, 2, 1), stock(2, 2, 1, 0, 0), stock(3, 2, 2, 9, 0), stock(4, 3, 1, 1, 2)
    )
    mart = operations.operations_mart(sold, stocked, DAY)
    assert mart.columns == S.OPERATIONS_MART.schema.names
    assert rows(mart) == [
        (1, 3.0, 0, "LOW", DAY), (2, None, 1, "HIGH", DAY), (3, None, 1, "MEDIUM", DAY),
        (7, None, 0, "LOW", DAY),
    ]


def test_web_session_rates(wtl, rows):
    visits = wtl(
        visit("a", 1, "PAGE_VIEW"), visit("a", 1, "BOUNCE"), visit("a", 1, "PAGE_VIEW"),
        visit("a", 1, None), visit("b", None, "BOUNCE"),
    )
    result = marketing.web_session_rates(visits)
    assert rows(result) == [("a", 1, 0.5, 0.25, 0.0, 0.5), ("b", None, 0.0, 1.0, 0.0, 0.0)]


def test_marketing_mart_joins_customers_of_both_sides(wtl, crm, rows):
    visits = wtl(
        visit("a", 1, "PAGE_VIEW"), visit("a", 1, "BOUNCE", at=dt.datetime(2024, 5, 8, 12, 1)),
        visit("b", 1, "PAGE_VIEW"), visit("c", 2, "PAGE_VIEW"), visit("d", None, "BOUNCE"),
    )
    contacts = crm(
        interaction(1, "LOYALTY_ACTION", 4), interaction(1, "FEEDBACK"), interaction(3, "FEEDBACK", 1),
        interaction(None, "FEEDBACK", 1),
    )
    mart = marketing.marketing_mart(visits, contacts, DAY)
    assert mart.columns == S.MARKETING_MART.schema.names
    assert rows(mart) == [(1, 2.0, 0.0, 0.5, 0.5, 1, DAY)]
    measured = marketing.marketing_mart(visits, contacts, DAY, measured_sessions=True)
    assert rows(measured, "avg_session_duration") == [(30.0,)]


def test_click_through_rate(wtl, rows):
    visits = wtl(
        visit("a", 1, "CLICK"), visit("a", 1, "PAGE_VIEW"), visit("a", 1, "PAGE_VIEW"),
        visit("b", 2, "CLICK", at=dt.datetime(2024, 5, 9)),
    )
    assert rows(marketing.click_through_daily(visits), "clicks", "page_views", "click_through_rate") == [
        (1, 0, 0.0), (1, 2, 0.5),
    ]


def test_feedback_score_counts_upper_case_feedback_only(crm, rows):
    contacts = crm(
        interaction(1, "FEEDBACK", 5), interaction(2, "FEEDBACK", 2), interaction(3, "FEEDBACK"),
        interaction(4, "COMPLAINT", 1),
    )
    assert rows(support.feedback_score(contacts)) == [("average_feedback_score", 3.5)]
    assert rows(support.feedback_score(contacts.limit(0))) == [("average_feedback_score", None)]
    assert rows(support.feedback_trend(contacts)) == [(DAY, 3.5, 2)]


def test_interaction_volume_is_sorted(crm):
    contacts = crm(interaction(1, "B"), interaction(2, "A"), interaction(3, "B"), interaction(4, None))
    assert [tuple(r) for r in support.interaction_volume(contacts).collect()] == [
        (None, 1), ("A", 1), ("B", 2),
    ]


def test_customer_support_mart(crm, rows):
    later = dt.datetime(2024, 5, 8, 18)
    contacts = crm(
        interaction(1, "COMPLAINT", 2), interaction(1, "RESOLUTION", 5, at=later),
        interaction(2, "FEEDBACK"), interaction(2, "LOYALTY_ACTION", at=later),
    )
    mart = support.customer_support_mart(contacts, DAY)
    assert mart.columns == S.SUPPORT_MART.schema.names
    assert rows(mart) == [(1, 3.5, 1, 0, 0, 6.0, DAY), (2, None, 0, 1, 1, None, DAY)]


LIVE = "batch int, customer_id string, interaction_type string, rating string, timestamp string"


def test_support_snapshot_per_batch(spark, rows):
    live = spark.createDataFrame(
        [
            (1, "7", "Complaint", "4", "100"), (1, "7", "Resolution", "bad", "220"),
            (1, "7", "Feedback", "6", "230"), (1, "0", "Feedback", "5", "100"),
            (1, None, "Feedback", "5", "100"), (1, "", "Feedback", "5", "100"),
            (1, "8", None, "5", "1"), (1, "8", "Feedback", "1", None),
            (2, "7", "Resolution", None, "400"),
            (3, "0", "Feedback", "5", "1"),
            (4, "9", "Feedback", "5", None),
        ],
        LIVE,
    )
    result = support.support_snapshot(live, stamp="batch")
    assert result.columns == [
        "feedback_score", "interaction_volume_by_type", "avg_time_to_resolution_minutes", "batch",
    ]
    # Batch 2 knows nothing of batch 1; batch 3 has no customer; batch 4 is cleaned away.
    assert sorted((r.batch, *tuple(r)[:3]) for r in result.collect()) == [
        (1, 4.5, '{"Complaint":1,"Resolution":1}', 2.0),
        (2, 0.0, '{"Resolution":1}', 0.0),
        (4, 0.0, "{}", 0.0),
    ]
