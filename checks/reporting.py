"""The seven reports, on the sums that the report job builds."""

from __future__ import annotations

from checks.basic import day_orders
from checks.oracle import report
from checks.registry import DAILY, MONTHLY, query
from daybook.operators import facts
from daybook.operators.scans import orders_for_day, orders_for_month
from daybook.plans import reports


def day_totals(t):
    return facts.day_totals(day_orders(t), t.order_items(), t.products(), t.categories())


def product_totals(t):
    return facts.per_product(day_totals(t))


def month_totals(t):
    orders = orders_for_month(t.orders(), MONTHLY)
    return facts.customer_day_sums(orders, t.order_items(), t.products(), t.categories())


@query("report_category_sales", report("category_sales", DAILY))
def category_sales(t):
    return reports.category_sales(product_totals(t), t.departments(), DAILY)


@query("report_department_sales", report("department_sales", DAILY))
def department_sales(t):
    return reports.department_sales(product_totals(t), t.departments(), DAILY)


@query("report_top_products_qty", report("top_products_qty", DAILY))
def top_products_qty(t):
    return reports.top_products_qty(product_totals(t), t.products(), DAILY)


@query("report_top_products_amount", report("top_products_amount", DAILY))
def top_products_amount(t):
    return reports.top_products_amount(product_totals(t), t.products(), DAILY)


@query("report_order_status", report("order_status", DAILY))
def order_status(t):
    orders = orders_for_day(t.orders(), DAILY.txn_date, all_statuses=True)
    return reports.order_status(orders, DAILY)


@query("report_top_customers_day", report("top_customers_day", DAILY))
def top_customers_day(t):
    return reports.top_customers_day(facts.per_customer(day_totals(t)), t.customers(), DAILY)


@query("report_top_customers_month", report("top_customers_month", MONTHLY))
def top_customers_month(t):
    return reports.top_customers_month(month_totals(t), t.customers(), MONTHLY)
