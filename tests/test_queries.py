"""Every registered query against its SQL in another engine."""

import pytest
from pyspark.sql import functions as F
from conftest import SAMPLES

from __spark_entry__ import entry, oracle_sql, queries
from checks.registry import ORACLE, QUERIES
from checks.compare import connect, mismatch
from daybook.functions import periods
from daybook.operators import scans


@pytest.fixture(scope="module")
def con():
    return connect(SAMPLES)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert mismatch(QUERIES[name](spark, SAMPLES), con, ORACLE[name]) is None


PERIOD_QUERIES = [
    "filter_partition_eq", "scan_orders_day", "scan_orders_day_all_status", "filter_month_prefix",
    "scan_orders_month", "filter_and", "agg_count_by_status", "fact_daily", "report_order_status",
    "report_department_sales", "report_top_customers_month", "job_reports_only", "job_daily",
]


@pytest.mark.parametrize("name", PERIOD_QUERIES)
def test_period_filters_are_checked(spark, con, monkeypatch, name):
    """With the period filters switched off, these no longer match their SQL."""
    for place in (scans, periods):
        monkeypatch.setattr(place, "on_day", lambda dt, day: F.lit(True))
        monkeypatch.setattr(place, "in_month", lambda dt, ctx: F.lit(True))
    assert mismatch(QUERIES[name](spark, SAMPLES), con, ORACLE[name]) is not None


def test_each_query_loads_the_orders_itself(spark):
    first, again = (QUERIES["scan_orders_day"](spark, SAMPLES).inputFiles() for _ in range(2))
    assert first and set(first).isdisjoint(again)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["department_id", "department_name", "total_sales", "txn_date"]
    assert df.count() == 4
