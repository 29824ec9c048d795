"""Plan guards for the registered queries: no row-at-a-time Python, no
cartesian or nested-loop joins, no window without a partition key."""

import re

import pytest

from postwise.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

BAD = ["BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"]
GLOBAL_WINDOW = re.compile(r"Window \[.*\], \[\], \[")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"stream_distinct_events"}))
def test_plan_is_distributed(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in BAD:
        assert bad not in plan, f"{name}: {bad}"
    assert not GLOBAL_WINDOW.search(plan), f"{name}: window without partition"


def test_scan_prunes_columns(spark):
    df = QUERIES["star_bench_top_suppliers"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_suppkey:bigint>" in plan


def test_filter_reaches_scan(spark):
    df = QUERIES["salary_trend_monthly"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(salary_min), IsNotNull(salary_max)" in plan


def test_runs_in_other_timezone(spark):
    """Registered results do not depend on the session time zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    utc = sorted(tuple(r) for r in QUERIES["parse_date"](spark, SF_SMALL).collect())
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Phnom_Penh")
        got = QUERIES["land_raw"](spark, SF_SMALL).select("load_timestamp").distinct().collect()
        assert [str(r[0]) for r in got] == ["2025-01-01 00:00:00"]
        local = sorted(tuple(r) for r in QUERIES["parse_date"](spark, SF_SMALL).collect())
        assert local == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
