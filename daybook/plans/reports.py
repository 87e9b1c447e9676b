"""The seven reports, each a function from DataFrames to a DataFrame.

Totals are computed before names are looked up, and top lists are cut before
their lookup: a product or customer without a dimension row then shortens the
list instead of being replaced by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.context import RunContext
from daybook.functions.casts import cast_to_sink
from daybook.functions.periods import with_period
from daybook.operators.metrics import count_by, enrich, sum_by, top_k
from daybook.schemas import REPORT_TABLES

# Rows per top list, decimals of money.
TOP_ROWS = 5
MONEY_SCALE = 2


def _finish(df: DataFrame, report: str, period: str) -> DataFrame:
    table = REPORT_TABLES[report]
    return with_period(cast_to_sink(df, table.columns), table.period_column, period)


def category_sales(fact: DataFrame, departments: DataFrame, ctx: RunContext) -> DataFrame:
    totals = sum_by(
        fact,
        ["category_id", "category_name", F.col("category_department_id").alias("department_id")],
        "order_item_subtotal",
        "total_sales",
        MONEY_SCALE,
    )
    return _finish(enrich(totals, departments, "department_id"), "category_sales", ctx.txn_date)


def department_sales(fact: DataFrame, departments: DataFrame, ctx: RunContext) -> DataFrame:
    totals = sum_by(
        fact,
        [F.col("category_department_id").alias("department_id")],
        "order_item_subtotal",
        "total_sales",
        MONEY_SCALE,
    )
    return _finish(enrich(totals, departments, "department_id"), "department_sales", ctx.txn_date)


def top_products_qty(fact: DataFrame, products: DataFrame, ctx: RunContext) -> DataFrame:
    totals = sum_by(fact, ["product_id"], "order_item_quantity", "total_qty")
    top = top_k(totals, "product_id", "total_qty", TOP_ROWS)
    return _finish(
        enrich(top, products, "product_id", TOP_ROWS), "top_products_qty", ctx.txn_date
    )


def top_products_amount(fact: DataFrame, products: DataFrame, ctx: RunContext) -> DataFrame:
    totals = sum_by(fact, ["product_id"], "order_item_subtotal", "total_amount", MONEY_SCALE)
    top = top_k(totals, "product_id", "total_amount", TOP_ROWS)
    return _finish(
        enrich(top, products, "product_id", TOP_ROWS), "top_products_amount", ctx.txn_date
    )


def order_status(orders_all_statuses: DataFrame, ctx: RunContext) -> DataFrame:
    counts = count_by(orders_all_statuses, ["order_status"], "order_id", "order_count")
    return _finish(counts, "order_status", ctx.txn_date)


def _top_customers(fact: DataFrame, customers: DataFrame) -> DataFrame:
    totals = sum_by(fact, ["customer_id"], "order_item_subtotal", "total_amount", MONEY_SCALE)
    top = top_k(totals, "customer_id", "total_amount", TOP_ROWS)
    return enrich(top, customers, "customer_id", TOP_ROWS)


def top_customers_day(fact: DataFrame, customers: DataFrame, ctx: RunContext) -> DataFrame:
    return _finish(_top_customers(fact, customers), "top_customers_day", ctx.txn_date)


def top_customers_month(fact: DataFrame, customers: DataFrame, ctx: RunContext) -> DataFrame:
    """Spend over the previous calendar month; the caller applies the first-of-month gate."""
    return _finish(_top_customers(fact, customers), "top_customers_month", ctx.txn_month)
