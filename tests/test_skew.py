"""Hot keys: a third and more of all rows under one key, and no broadcast to hide it.

The expected totals are computed from the rows themselves in plain Python.
"""

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from daybook.context import RunContext
from daybook.operators import facts, scans
from daybook.plans import reports

CTX = RunContext(date(2021, 3, 2))
DAY = CTX.txn_date
ITEMS = 60_000


@pytest.fixture(scope="module")
def tables(spark):
    """40 % of the items on one order, 40 % on one product, half of the orders by one customer."""
    orders = spark.range(3000).selectExpr(
        "id AS order_id",
        f"'{DAY}' AS order_date",
        "IF(id % 2 = 0, 7L, id % 211) AS order_customer_id",
        "IF(id % 17 = 0, 'ON_HOLD', 'COMPLETE') AS order_status",
        f"'{DAY}' AS dt",
    )
    items = spark.range(ITEMS).selectExpr(
        "id + 1 AS order_item_id",
        "IF(id % 5 < 2, 1L, id % 3100) AS order_item_order_id",
        "IF(id % 5 IN (1, 2), 3L, id % 997) AS order_item_product_id",
        "CAST(id % 4 AS INT) AS order_item_quantity",
        "CAST(id % 1000 AS DOUBLE) / 4 AS order_item_subtotal",
    )
    products = spark.range(990).selectExpr(
        "id AS product_id",
        "CAST(id % 30 AS INT) AS product_category_id",
        "concat('p', id) AS product_name",
    )
    categories = spark.range(25).selectExpr(
        "CAST(id AS INT) AS category_id",
        "CAST(id % 4 AS INT) AS category_department_id",
        "concat('c', id) AS category_name",
    )
    departments = spark.range(4).selectExpr(
        "CAST(id AS INT) AS department_id", "concat('d', id) AS department_name"
    )
    customers = spark.range(211).selectExpr(
        "id AS customer_id", "'f' AS customer_fname", "'l' AS customer_lname",
        "'c' AS customer_city", "'s' AS customer_state",
    )
    frames = dict(orders=orders, order_items=items, products=products, categories=categories)
    frames |= dict(departments=departments, customers=customers)
    return frames


@pytest.fixture(scope="module")
def expected(tables):
    orders = {
        r.order_id: r.order_customer_id
        for r in tables["orders"].collect()
        if r.order_status == "COMPLETE"
    }
    category = {
        r.product_id: r.product_category_id
        for r in tables["products"].collect()
        if r.product_category_id < 25
    }
    sums = {k: Counter() for k in ("department", "category", "qty", "amount", "customer")}
    for r in tables["order_items"].collect():
        product = r.order_item_product_id
        if r.order_item_order_id not in orders or product not in category:
            continue
        sums["category"][category[product]] += r.order_item_subtotal
        sums["department"][category[product] % 4] += r.order_item_subtotal
        sums["qty"][product] += r.order_item_quantity
        sums["amount"][product] += r.order_item_subtotal
        sums["customer"][orders[r.order_item_order_id]] += r.order_item_subtotal
    return sums


def top5(sums):
    return dict(sorted(sums.items(), key=lambda kv: (-kv[1], kv[0]))[:5])


@pytest.mark.parametrize("build", [facts.sales_fact, facts.compact_sales_fact, facts.day_totals])
def test_reports_on_hot_keys(spark, conf, tables, expected, build):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "16k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    fact = build(
        scans.orders_for_day(tables["orders"], DAY),
        tables["order_items"],
        tables["products"],
        tables["categories"],
    )

    by_product, by_customer = fact, fact
    if build is facts.day_totals:
        by_product, by_customer = facts.per_product(fact), facts.per_customer(fact)

    def result(df, key, value):
        return {r[key]: r[value] for r in df.collect()}

    departments = reports.department_sales(by_product, tables["departments"], CTX)
    assert result(departments, "department_id", "total_sales") == dict(expected["department"])
    categories = reports.category_sales(by_product, tables["departments"], CTX)
    assert result(categories, "category_id", "total_sales") == dict(expected["category"])
    by_qty = reports.top_products_qty(by_product, tables["products"], CTX)
    assert result(by_qty, "product_id", "total_qty") == top5(expected["qty"])
    by_amount = reports.top_products_amount(by_product, tables["products"], CTX)
    assert result(by_amount, "product_id", "total_amount") == top5(expected["amount"])
    customers = reports.top_customers_day(by_customer, tables["customers"], CTX)
    assert result(customers, "customer_id", "total_amount") == top5(expected["customer"])


def test_hot_product_is_split_with_categories_broadcast(spark, conf, tables, expected):
    """Products are too many to broadcast, categories are not."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "8k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    totals = facts.day_totals(
        scans.orders_for_day(tables["orders"], DAY),
        tables["order_items"].repartition(8),
        tables["products"],
        F.broadcast(tables["categories"]),
    )
    top = reports.top_products_qty(facts.per_product(totals), tables["products"], CTX)
    assert {r.product_id: r.total_qty for r in top.collect()} == top5(expected["qty"])
    plan = top._jdf.queryExecution().toString()
    final = plan[plan.index("== Physical Plan") :]
    product_join = next(line for line in final.splitlines() if "SortMergeJoin" in line and "product" in line)
    assert "skew=true" in product_join


def test_customers_of_hot_orders_summed_per_order(spark, conf, tables, expected):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    fact = facts.customer_sales_fact(
        scans.orders_for_day(tables["orders"], DAY),
        tables["order_items"],
        tables["products"],
        tables["categories"],
    )
    top = reports.top_customers_day(fact, tables["customers"], CTX)
    assert {r.customer_id: r.total_amount for r in top.collect()} == top5(expected["customer"])


def test_hot_order_is_split_at_run_time(spark, conf, tables):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "8k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    joined = facts.join_orders(
        tables["order_items"].repartition(8), scans.orders_for_day(tables["orders"], DAY)
    )
    total = joined.agg(F.count("*").alias("n"), F.max(F.hash("order_item_id", "order_item_subtotal")))
    kept = {r.order_id for r in scans.orders_for_day(tables["orders"], DAY).collect()}
    by_hand = sum(
        r.order_item_order_id in kept for r in tables["order_items"].collect()
    )
    assert total.collect()[0]["n"] == by_hand
    assert "SortMergeJoin(skew=true)" in total._jdf.queryExecution().toString()
