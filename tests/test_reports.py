from datetime import date

import pytest
from pyspark.sql import functions as F
from shop import DAY, frames, rows

from daybook.context import RunContext
from daybook.operators import facts, metrics, scans
from daybook.plans import reports

CTX = RunContext(date(2021, 3, 2))
ALL_FACTS = [facts.sales_fact, facts.compact_sales_fact, facts.customer_sales_fact]


def build(tables, fact=facts.sales_fact):
    sales = scans.orders_for_day(tables["orders"], DAY)
    return fact(sales, tables["order_items"], tables["products"], tables["categories"])


@pytest.fixture(params=[facts.sales_fact, facts.compact_sales_fact])
def kind(request):
    return request.param


def test_only_complete_sales_rows_reach_the_fact(spark):
    fact = build(frames(spark))
    assert rows(fact, "order_item_id") == [(1,), (11,), (12,), (2,), (3,), (7,)]
    assert fact.columns == [
        "category_id", "category_department_id", "category_name", "customer_id", "product_id",
        "order_item_id", "order_item_order_id", "order_item_product_id",
        "order_item_quantity", "order_item_subtotal",
    ]


def test_category_and_department_sales(spark, kind):
    tables = frames(spark)
    fact = build(tables, kind)
    assert rows(reports.category_sales(fact, tables["departments"], CTX), "*") == [
        (10, "Lamps", "Home", 30.25, DAY),
        (11, "Chairs", "Home", 100.1, DAY),
        (12, "Pots", "Garden", 40.3, DAY),
    ]
    assert rows(reports.department_sales(fact, tables["departments"], CTX), "*") == [
        (1, "Home", 130.35, DAY),
        (2, "Garden", 40.3, DAY),
    ]


def test_top_products_keep_categories_without_department(spark, kind):
    tables = frames(spark)
    fact = build(tables, kind)
    by_qty = reports.top_products_qty(fact, tables["products"], CTX)
    assert rows(by_qty, "product_id", "total_qty") == [
        (100, 3.0), (101, 1.0), (102, 4.0), (103, 4.0)
    ]
    by_amount = reports.top_products_amount(fact, tables["products"], CTX)
    assert rows(by_amount, "product_name", "total_amount") == [
        ("chair", 100.1), ("lamp", 30.25), ("lost", 5000.0), ("pot", 40.3)
    ]


def test_order_status_counts_every_state_and_null(spark):
    orders = scans.orders_for_day(frames(spark)["orders"], DAY, all_statuses=True)
    assert rows(reports.order_status(orders, CTX), "*") == [
        ("CANCELED", 1, DAY),
        ("COMPLETE", 4, DAY),
        ("ON_HOLD", 1, DAY),
        ("PENDING", 1, DAY),
        (None, 1, DAY),
    ]


@pytest.mark.parametrize("kind", ALL_FACTS)
def test_missing_customer_shortens_the_list(spark, kind):
    """Five places; the top one belongs to a customer without a row."""
    tables = frames(spark)
    extra = [(20, DAY, 5, "COMPLETE", DAY), (21, DAY, 8, "COMPLETE", DAY)]
    items = [(30, 20, 100, 1, 3.0), (31, 21, 100, 1, 2.0)]
    tables = frames(
        spark,
        orders=[*map(tuple, tables["orders"].collect()), *extra],
        order_items=[*map(tuple, tables["order_items"].collect()), *items],
    )
    top = reports.top_customers_day(build(tables, kind), tables["customers"], CTX)
    assert rows(top, "customer_id", "total_amount") == [
        (1, 120.35), (2, 30.3), (3, 10.0), (4, 10.0)
    ]


def test_ties_go_to_the_lowest_ids(spark):
    totals = spark.createDataFrame([(i, 5) for i in range(7, 0, -1)], "id int, n int")
    assert rows(metrics.top_k(totals, "id", "n", 5), "id") == [(1,), (2,), (3,), (4,), (5,)]


def test_duplicate_category_doubles_the_sum(spark, kind):
    base = frames(spark)
    categories = [*map(tuple, base["categories"].collect()), (12, 2, "Pots")]
    tables = frames(spark, categories=categories)
    sales = reports.department_sales(build(tables, kind), tables["departments"], CTX)
    assert rows(sales.where("department_id = 2"), "total_sales") == [(80.6,)]


@pytest.mark.parametrize("kind", [facts.sales_fact, facts.customer_sales_fact])
def test_month_report(spark, kind):
    tables = frames(spark)
    ctx = RunContext(date(2021, 4, 1))
    sales = scans.orders_for_month(tables["orders"], ctx)
    fact = kind(sales, tables["order_items"], tables["products"], tables["categories"])
    top = reports.top_customers_month(fact, tables["customers"], ctx)
    assert rows(top, "customer_id", "total_amount", "txn_month") == [
        (1, 190.35, "2021-03"), (2, 30.3, "2021-03"), (3, 10.0, "2021-03"), (4, 10.0, "2021-03")
    ]


def test_money_is_rounded_half_up_after_summing(spark):
    df = spark.createDataFrame([(1, 0.25), (1, 0.125), (2, 0.125)], "k int, v double")
    assert rows(metrics.sum_by(df, ["k"], "v", "s", 2), "*") == [(1, 0.38), (2, 0.13)]


def test_id_beyond_int_raises(spark):
    tables = frames(spark)
    big = 2**31
    fact = build(tables).withColumn("customer_id", F.lit(big))
    customers = spark.createDataFrame([(big, "a", "b", "c", "d")], tables["customers"].schema)
    with pytest.raises(Exception, match="(?i)overflow"):
        reports.top_customers_day(fact, customers, CTX).collect()


def test_id_beyond_int_raises_without_ansi(spark, conf):
    conf("spark.sql.ansi.enabled", "false")
    test_id_beyond_int_raises(spark)


def test_cached_fact_gives_the_same_rows_and_is_released(spark):
    tables = frames(spark)
    plain = build(tables)
    with facts.cached(plain.select(*facts.REPORT_COLUMNS)) as kept:
        assert kept.storageLevel.useMemory and kept.storageLevel.useDisk
        assert rows(kept, "*") == rows(plain, *facts.REPORT_COLUMNS)
    assert not kept.storageLevel.useMemory


def test_items_in_order_range_keeps_every_joining_item(spark):
    tables = frames(spark)
    sales = scans.orders_for_day(tables["orders"], DAY)
    pruned = scans.items_in_order_range(tables["order_items"], sales)
    assert pruned.count() < tables["order_items"].count()
    everything = facts.join_orders(tables["order_items"], sales)
    assert rows(facts.join_orders(pruned, sales), "order_item_id") == rows(
        everything, "order_item_id"
    )
    none = scans.items_in_order_range(tables["order_items"], sales.where("false"))
    assert none.count() == 0
