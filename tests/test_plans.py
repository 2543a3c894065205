"""Shape of the plans: what must hold on a cluster, read off the physical plan."""

import datetime as dt
import re

import pytest

from tillhouse import queries as Q
from tillhouse import schemas as S
from tillhouse.operators.survivors import keep_newest
from tillhouse.plans import operations

SF_DIR = "/root/testdata/sf0.001"
# Queries that write nothing before they return, so that building them is free.
LAZY = sorted(
    name
    for name in Q.REGISTRY
    if not re.search(r"stream|scan|landing|roundtrip|csv|moved|merge_crm|merge_wtl|latest|audit|stored|job_", name)
)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_no_python_no_forced_broadcast(spark, name):
    result = Q.REGISTRY[name](spark, SF_DIR)
    plan = physical(result)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "ArrowEval"):
        assert operator not in plan
    assert "ResolvedHint" not in result._jdf.queryExecution().logical().toString()


def test_copies_collapse_before_the_shuffle(spark):
    plan = physical(keep_newest(spark.range(9).selectExpr("id % 2 AS k", "id AS v"), ["k"], "v"))
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning")  # below it


def test_scans_read_only_the_columns_a_query_needs(spark):
    plan = physical(Q.REGISTRY["stockout_alerts"](spark, SF_DIR))
    assert "p_partkey" in plan and "p_name" not in plan
    plan = physical(Q.REGISTRY["envelope_decode"](spark, SF_DIR))
    assert "value" not in re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,F)]" in physical(
        Q.REGISTRY["merge_pos"](spark, SF_DIR)
    )


def test_a_check_is_not_pushed_below_the_deduplication(spark):
    plan = physical(Q.REGISTRY["silver_pos"](spark, SF_DIR))
    assert plan.index("Filter") < plan.index("SortAggregate")
    assert plan.rindex("Filter (") < plan.rindex("SortAggregate")


def test_day_filter_reaches_the_scan(spark, folder):
    spark.createDataFrame([], S.SILVER_INVENTORY).write.parquet(folder, mode="overwrite")
    stored = spark.read.schema(S.SILVER_INVENTORY).parquet(folder)
    plan = physical(operations.stockout_alerts(stored, dt.date(2024, 5, 8)))
    assert "GreaterThanOrEqual(last_updated,2024-05-08" in plan


def test_a_stored_day_is_read_from_its_folder(spark):
    result = Q.REGISTRY["silver_day_scan"](spark, "/root/testdata/sf0.01")
    assert "PartitionFilters: [isnotnull(year" in physical(result)
    assert result.inputFiles() and all("month=1/day=20/" in f for f in result.inputFiles())


def test_a_plan_does_not_depend_on_what_ran_before(spark):
    def shape():
        plan = physical(Q.REGISTRY["sales_mart"](spark, SF_DIR))
        return re.sub(r"#\d+L?|plan_id=\d+|Location.*", "", plan), dict(spark.conf.getAll)

    before = shape()
    for name in ("sales_mart_month", "web_sessions_gap", "dq_profile"):
        Q.REGISTRY[name](spark, "/root/testdata/sf0.01").count()
    assert shape() == before


def test_store_label_is_found_without_sorting_sales(spark):
    plan = physical(Q.REGISTRY["sales_by_store"](spark, SF_DIR))
    assert not re.search(r"SortAggregate\(key=\[store_id", plan)
