"""Physical plans: pruning, pushdown, broadcast only below the size bound."""

import re

import pytest
from pyspark.sql import functions as F
from conftest import SAMPLES
from shop import DAY, OTHER_DAY, frames

from __spark_entry__ import queries
from checks.registry import DAILY
from daybook.operators import facts, scans
from daybook.plans import reports
from daybook.session import CLUSTER_SETTINGS
from daybook.sinks import tables
from daybook.sources import ingest


QUERIES = queries()


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def final_plan(df):
    df.collect()
    return plan(df)


@pytest.fixture
def warehouse(spark, database):
    model = frames(spark)
    ingest.load_orders_partitions(spark, model["orders"], database)
    for name in ("order_items", "products", "categories", "departments", "customers"):
        model[name].write.saveAsTable(f"{database}.{name}")
    return lambda name: spark.table(f"{database}.{name}")


def test_one_day_is_one_directory(warehouse):
    day = scans.orders_for_day(warehouse("orders"), DAY)
    text = plan(day)
    assert "PartitionFilters: [isnotnull(dt" in text and f"= {DAY})" in text
    assert "cast(dt" not in text
    files = {r[0] for r in day.selectExpr("input_file_name()").collect()}
    assert files and all(f"dt={DAY}/" in f for f in files)
    assert scans.orders_for_day(warehouse("orders"), OTHER_DAY).count() == 1


def test_month_filter_prunes_partitions(warehouse):
    text = plan(scans.orders_for_month(warehouse("orders"), DAILY))
    assert re.search(r"PartitionFilters: \[isnotnull\(dt#\d+\), \(dt#\d+ >= ", text)


def test_fact_reads_only_report_columns(spark, warehouse):
    fact = facts.compact_sales_fact(
        scans.orders_for_day(warehouse("orders"), DAY),
        warehouse("order_items"),
        warehouse("products"),
        warehouse("categories"),
    )
    text = plan(fact)
    assert (
        "ReadSchema: struct<order_item_order_id:bigint,order_item_product_id:bigint,"
        "order_item_quantity:int,order_item_subtotal:double>" in text
    )
    assert "ReadSchema: struct<product_id:bigint,product_category_id:int>" in text


def test_item_range_reaches_the_scan(warehouse):
    sales = scans.orders_for_day(warehouse("orders"), DAY)
    text = plan(scans.items_in_order_range(warehouse("order_items"), sales))
    assert "GreaterThanOrEqual(order_item_order_id,1), LessThanOrEqual(order_item_order_id,8)" in text


def test_newer_items_reach_the_scan(warehouse):
    text = plan(warehouse("order_items").where(scans.newer_than("order_item_id", 5)))
    assert "GreaterThan(order_item_id,5)" in text


def test_scan_of_all_days_prunes_to_one(spark):
    text = plan(QUERIES["scan_orders_day"](spark, SAMPLES))
    assert re.search(r"PartitionFilters: \[isnotnull\(dt#\d+\), \(dt#\d+ = 2000-02-03\)\]", text)


@pytest.mark.parametrize(
    "name", ["report_top_products_qty", "report_top_products_amount", "report_top_customers_day"]
)
def test_top_lists_take_without_a_full_sort(spark, name):
    text = plan(QUERIES[name](spark, SAMPLES))
    assert "TakeOrderedAndProject" in text
    assert not re.search(r"rangepartitioning", text)


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("report_")])
def test_reports_have_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SAMPLES))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert forbidden not in text


def test_only_top_rows_are_broadcast_when_nothing_fits(spark, conf):
    """With a zero size bound every join shuffles, but for the five rows of a top list."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    category = plan(QUERIES["report_category_sales"](spark, SAMPLES))
    assert "BroadcastExchange" not in category and "SortMergeJoin" in category
    product = plan(QUERIES["report_top_products_qty"](spark, SAMPLES))
    tree = product.split("\n\n")[0]
    assert tree.count("BroadcastExchange") == 1
    assert tree.index("BroadcastExchange") < tree.index("TakeOrderedAndProject")
    assert tree.count("SortMergeJoin") == 3


def test_compact_fact_sums_before_the_catalog_join(spark, conf, warehouse):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    fact = facts.compact_sales_fact(
        scans.orders_for_day(warehouse("orders"), DAY),
        warehouse("order_items"),
        warehouse("products"),
        warehouse("categories"),
    )
    tree = plan(fact).split("\n\n")[0]
    assert tree.count("HashAggregate") == 2
    first_aggregate = tree.index("HashAggregate")
    assert tree.rindex("SortMergeJoin") > first_aggregate  # items with orders, below
    assert tree.index("SortMergeJoin") < first_aggregate  # catalog, above


def test_order_sums_need_no_second_shuffle_for_the_join(spark, conf, warehouse):
    """Sums per order are already partitioned by order id when they meet the orders."""
    fact = facts.customer_sales_fact(
        scans.orders_for_day(warehouse("orders"), DAY).hint("merge"),
        warehouse("order_items"),
        warehouse("products"),
        warehouse("categories"),
    )
    tree = plan(fact).split("\n\n")[0]
    assert tree.count("SortMergeJoin") == 1
    assert len(re.findall(r"(?<!Broadcast)Exchange", tree)) == 2  # order sums, orders


def test_month_orders_thin_the_items_before_any_shuffle(spark):
    """Orders that can be broadcast meet the items first, although their ids do not follow time."""
    orders = spark.range(200).selectExpr(
        "(id * 7919) % 5003 AS order_id", "id % 9 AS order_customer_id", "'COMPLETE' AS order_status"
    )
    items = spark.range(20_000).selectExpr(
        "id % 5003 AS order_item_order_id", "id % 5 AS order_item_product_id",
        "1 AS order_item_quantity", "1.0D AS order_item_subtotal",
    )
    products = spark.range(5).selectExpr("id AS product_id", "0 AS product_category_id")
    categories = spark.range(1).selectExpr(
        "CAST(id AS INT) AS category_id", "0 AS category_department_id", "'c' AS category_name"
    )
    fact = facts.customer_sales_fact(F.broadcast(orders), items, F.broadcast(products), F.broadcast(categories))
    tree = plan(fact).split("\n\n")[0]
    # The tree lists what runs last first: the one exchange is above all joins.
    assert len(re.findall(r"(?<!Broadcast)Exchange", tree)) == 1
    assert re.search(r"(?<!Broadcast)Exchange", tree).start() < tree.index("BroadcastHashJoin")
    kept = {r.order_id for r in orders.collect()}
    by_hand = sum(r.order_item_order_id in kept for r in items.collect())
    assert fact.agg(F.sum("order_item_subtotal")).first()[0] == by_hand


def test_write_needs_no_shuffle_of_its_own(spark, database, warehouse):
    """A report is one aggregation: one exchange, then the write."""
    orders = scans.orders_for_day(warehouse("orders"), DAY, all_statuses=True)
    assert plan(reports.order_status(orders, DAILY)).split("\n\n")[0].count("Exchange") == 1
    assert tables.replace_report(reports.order_status(orders, DAILY), database, "order_status", DAY)


def test_cluster_settings_are_known_to_spark(spark, conf):
    for key, value in CLUSTER_SETTINGS.items():
        if key.startswith("spark.sql."):
            spark.conf.get(key)  # raises for a name Spark does not know
            conf(key, value)
    assert QUERIES["report_department_sales"](spark, SAMPLES).count() == 4


def test_bloom_filter_thins_the_item_scan(spark, conf, warehouse):
    """A day too large to broadcast still filters the items before their shuffle."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "1b")
    for key, value in CLUSTER_SETTINGS.items():
        if ".bloomFilter." in key:
            conf(key, value)
    for fact in (facts.sales_fact, facts.compact_sales_fact):
        df = fact(
            scans.orders_for_day(warehouse("orders"), DAY),
            warehouse("order_items"),
            warehouse("products"),
            warehouse("categories"),
        )
        text = plan(df)
        assert re.search(r"might_contain\(.*xxhash64\(order_item_order_id", text)
        assert re.search(r"bloom_filter_agg\(.*, 20000000, 160000000", text)
