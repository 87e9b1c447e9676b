"""SQL building blocks for checking the queries in another engine.

The statements restate each result from the sample tables; they share nothing
with the Spark code but the meaning.
"""

from __future__ import annotations

from daybook.context import RunContext

# The sales model over the sample tables.
MODEL = {
    "departments": "SELECT r_regionkey AS department_id, r_name AS department_name FROM region",
    "categories": (
        "SELECT n_nationkey AS category_id, n_regionkey AS category_department_id, "
        "n_name AS category_name FROM nation"
    ),
    "products": (
        "SELECT p_partkey AS product_id, "
        "CAST(substr(p_brand, 7) AS INTEGER) - 1 AS product_category_id, "
        "p_name AS product_name FROM part"
    ),
    "customers": (
        "SELECT c_custkey AS customer_id, substr(c_name, 1, 8) AS customer_fname, "
        "substr(c_name, 10) AS customer_lname, n_name AS customer_city, "
        "r_name AS customer_state FROM customer, nation, region "
        "WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey"
    ),
    "sales_orders": (
        "SELECT o_orderkey AS order_id, "
        "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, "
        "o_custkey AS order_customer_id, "
        "CASE WHEN o_orderstatus = 'F' THEN 'COMPLETE' WHEN o_orderstatus = 'O' THEN 'PENDING' "
        "WHEN o_orderpriority = '5-LOW' THEN 'CANCELED' "
        "WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'ON_HOLD' "
        "ELSE 'PROCESSING' END AS order_status, "
        "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS dt FROM orders"
    ),
    "order_items": (
        "SELECT l_orderkey * 10 + l_linenumber AS order_item_id, "
        "l_orderkey AS order_item_order_id, l_partkey AS order_item_product_id, "
        "CAST(l_quantity AS INTEGER) AS order_item_quantity, "
        "l_extendedprice AS order_item_subtotal FROM lineitem"
    ),
}

SALES_ONLY = "order_status NOT IN ('CANCELED', 'ON_HOLD')"


def statement(query: str, **ctes: str) -> str:
    """``query`` with the model and further named subqueries in front."""
    named = {**MODEL, **ctes}
    return "WITH " + ", ".join(f"{k} AS ({v})" for k, v in named.items()) + " " + query


def day_of(ctx: RunContext) -> str:
    """The reported day, derived from the run date by the other engine."""
    return f"strftime(DATE '{ctx.run_date}' - {ctx.lag_days}, '%Y-%m-%d')"


def month_of(ctx: RunContext) -> str:
    first = f"date_trunc('month', DATE '{ctx.run_date}')"
    return f"strftime({first} - INTERVAL 1 DAY, '%Y-%m')"


def in_day(ctx: RunContext) -> str:
    return f"dt = {day_of(ctx)}"


def in_month(ctx: RunContext) -> str:
    return f"substr(dt, 1, 7) = {month_of(ctx)}"


def fact(period: str, orders: str = "sales_orders") -> str:
    """Sold items of a period with category, product and customer."""
    return (
        "SELECT category_id, category_department_id, category_name, "
        "order_customer_id AS customer_id, product_id, order_item_id, order_item_order_id, "
        "order_item_product_id, order_item_quantity, order_item_subtotal "
        f"FROM {orders} JOIN order_items ON order_id = order_item_order_id "
        "JOIN products ON order_item_product_id = product_id "
        f"JOIN categories ON product_category_id = category_id WHERE {period} AND {SALES_ONLY}"
    )


def totals(keys: str, measure: str, name: str, source: str = "fact") -> str:
    return f"SELECT {keys}, {measure} AS {name} FROM {source} GROUP BY ALL"


MONEY = "round(sum(order_item_subtotal), 2)"
PIECES = "CAST(sum(order_item_quantity) AS BIGINT)"


def top(source: str, measure: str, key: str) -> str:
    return f"SELECT * FROM {source} ORDER BY {measure} DESC, {key} LIMIT 5"


def report_ctes(ctx: RunContext, orders: str = "sales_orders", prefix: str = "") -> dict[str, str]:
    """Every report of a run as a named subquery, with the subqueries it needs."""
    p = prefix
    customer = "customer_fname, customer_lname, customer_city, customer_state"
    ctes = {f"{p}fact": fact(in_day(ctx), orders), f"{p}month_fact": fact(in_month(ctx), orders)}

    ctes[f"{p}category_sales"] = (
        "SELECT category_id, category_name, department_name, "
        f"{MONEY} AS total_sales, {day_of(ctx)} AS txn_date "
        f"FROM {p}fact JOIN departments ON category_department_id = department_id "
        "GROUP BY category_id, category_name, category_department_id, department_name"
    )
    ctes[f"{p}department_sales"] = (
        f"SELECT department_id, department_name, {MONEY} AS total_sales, "
        f"{day_of(ctx)} AS txn_date "
        f"FROM {p}fact JOIN departments ON category_department_id = department_id "
        "GROUP BY department_id, department_name"
    )
    for report, measure, column in (
        ("top_products_qty", PIECES, "total_qty"),
        ("top_products_amount", MONEY, "total_amount"),
    ):
        ctes[f"{p}{report}_sum"] = totals("product_id", measure, column, f"{p}fact")
        ctes[f"{p}{report}_top"] = top(f"{p}{report}_sum", column, "product_id")
        ctes[f"{p}{report}"] = (
            "SELECT CAST(product_id AS INTEGER) AS product_id, product_name, "
            f"CAST({column} AS DOUBLE) AS {column}, {day_of(ctx)} AS txn_date "
            f"FROM {p}{report}_top JOIN products USING (product_id)"
        )
    ctes[f"{p}order_status"] = (
        f"SELECT order_status, count(order_id) AS order_count, {day_of(ctx)} AS txn_date "
        f"FROM {orders} WHERE {in_day(ctx)} GROUP BY order_status"
    )
    for report, source, period in (
        ("top_customers_day", f"{p}fact", f"{day_of(ctx)} AS txn_date"),
        ("top_customers_month", f"{p}month_fact", f"{month_of(ctx)} AS txn_month"),
    ):
        ctes[f"{p}{report}_sum"] = totals("customer_id", MONEY, "total_amount", source)
        ctes[f"{p}{report}_top"] = top(f"{p}{report}_sum", "total_amount", "customer_id")
        ctes[f"{p}{report}"] = (
            f"SELECT CAST(customer_id AS INTEGER) AS customer_id, {customer}, total_amount, "
            f"{period} FROM {p}{report}_top JOIN customers USING (customer_id)"
        )
    return ctes


def report(name: str, ctx: RunContext) -> str:
    return statement(f"SELECT * FROM {name}", **report_ctes(ctx))


# Entity, label and value column of each report, for results of whole jobs.
LONG_COLUMNS = {
    "category_sales": ("category_id", "category_name", "total_sales"),
    "department_sales": ("department_id", "department_name", "total_sales"),
    "top_products_qty": ("product_id", "product_name", "total_qty"),
    "top_products_amount": ("product_id", "product_name", "total_amount"),
    "order_status": ("order_status", "order_status", "order_count"),
    "top_customers_day": ("customer_id", "customer_lname", "total_amount"),
    "top_customers_month": ("customer_id", "customer_lname", "total_amount"),
}


def long_form(reports: list[str], prefix: str = "") -> str:
    """Rows of several reports in one layout."""
    parts = []
    for name in reports:
        entity, label, value = LONG_COLUMNS[name]
        period = "txn_month" if name == "top_customers_month" else "txn_date"
        parts.append(
            f"SELECT '{name}' AS report, {period} AS period, CAST({entity} AS VARCHAR) AS entity, "
            f"{label} AS label, CAST({value} AS DOUBLE) AS value FROM {prefix}{name}"
        )
    return " UNION ALL ".join(parts)
