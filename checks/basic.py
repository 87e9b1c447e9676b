"""Single operators: scans, projections, filters, joins, aggregates, top lists, functions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks.oracle import (
    MONEY,
    PIECES,
    SALES_ONLY,
    fact,
    in_day,
    in_month,
    report_ctes,
    statement,
    top,
    totals,
)
from checks.registry import DAILY, MONTHLY, query
from daybook.functions import periods
from daybook.functions.casts import cast_to_sink
from daybook.functions.rebase import max_order_date, rebase_order_dates
from daybook.operators import facts, metrics, scans
from daybook.plans.reports import MONEY_SCALE, TOP_ROWS
from daybook.schemas import MODEL, REPORT_TABLES
from daybook.session import create_scratch_database
from daybook.sinks.tables import qualified
from daybook.sources import ingest
from daybook.sources.readers import SourceFilter
from daybook.sources.samples import SampleTables

# Tasks that load many days at once.
BACKFILL_TASKS = 8

DAY, MONTH = in_day(DAILY), in_month(MONTHLY)


def all_days(t: SampleTables):
    """The orders of all days, loaded into a table partitioned by day as in the warehouse."""
    database = create_scratch_database(t.spark)
    ingest.load_orders_partitions(t.spark, t.orders(), database, BACKFILL_TASKS)
    return t.spark.table(qualified(database, "orders"))


def day_orders(t: SampleTables):
    return scans.orders_for_day(t.orders(), DAILY.txn_date)


def day_fact(t: SampleTables):
    return facts.sales_fact(day_orders(t), t.order_items(), t.products(), t.categories())


def month_fact(t: SampleTables):
    orders = scans.orders_for_month(t.orders(), MONTHLY)
    return facts.sales_fact(orders, t.order_items(), t.products(), t.categories())


# --- scans and views ---------------------------------------------------------


@query("scan_categories", statement("SELECT * FROM categories"))
def scan_categories(t):
    return t.categories()


@query("scan_departments", statement("SELECT * FROM departments"))
def scan_departments(t):
    return t.departments()


@query("scan_customers", statement("SELECT * FROM customers"))
def scan_customers(t):
    return t.customers()


@query("scan_order_items", statement("SELECT * FROM order_items"))
def scan_order_items(t):
    return t.order_items()


@query("scan_products", statement("SELECT * FROM products"))
def scan_products(t):
    return t.products()


@query(
    "scan_orders_day", statement(f"SELECT * FROM sales_orders WHERE {DAY} AND {SALES_ONLY}")
)
def scan_orders_day(t):
    return scans.orders_for_day(all_days(t), DAILY.txn_date)


@query("scan_orders_day_all_status", statement(f"SELECT * FROM sales_orders WHERE {DAY}"))
def scan_orders_day_all_status(t):
    return scans.orders_for_day(all_days(t), DAILY.txn_date, all_statuses=True)


@query(
    "scan_orders_month", statement(f"SELECT * FROM sales_orders WHERE {MONTH} AND {SALES_ONLY}")
)
def scan_orders_month(t):
    return scans.orders_for_month(all_days(t), MONTHLY)


@query(
    "named_view",
    statement(
        "SELECT department_name, count(*) AS category_count "
        "FROM categories, departments WHERE category_department_id = department_id GROUP BY 1"
    ),
)
def named_view(t):
    t.categories().createOrReplaceTempView("daybook_categories")
    t.departments().createOrReplaceTempView("daybook_departments")
    return t.spark.sql(
        "SELECT department_name, count(*) AS category_count FROM daybook_categories "
        "JOIN daybook_departments ON category_department_id = department_id "
        "GROUP BY department_name"
    )


@query(
    "cached_fact",
    statement(
        f"SELECT category_id, category_department_id, category_name, {MONEY} AS total_sales "
        "FROM fact GROUP BY ALL",
        fact=fact(DAY),
    ),
)
def cached_fact(t):
    database = create_scratch_database(t.spark)
    table = qualified(database, "category_totals")
    keys = ["category_id", "category_department_id", "category_name"]
    with facts.cached(day_fact(t).select(*facts.REPORT_COLUMNS)) as kept:
        totals_ = metrics.sum_by(kept, keys, "order_item_subtotal", "total_sales", MONEY_SCALE)
        totals_.write.format("parquet").saveAsTable(table)
    return t.spark.table(table)


# --- projections -------------------------------------------------------------


@query("project_star", statement("SELECT * FROM sales_orders"))
def project_star(t):
    return t.orders().select("*")


@query(
    "project_qualified_star",
    statement(
        "SELECT category_id, category_department_id, category_name, customer_id, product_id, "
        "order_item_id, order_item_order_id, order_item_product_id, order_item_quantity, "
        "order_item_subtotal FROM fact",
        fact=fact("true"),
    ),
)
def project_qualified_star(t):
    sales = t.orders().where(scans.exclude_status(F.col("order_status")))
    return facts.sales_fact(sales, t.order_items(), t.products(), t.categories())


@query(
    "project_rename",
    statement("SELECT order_id, order_customer_id AS customer_id FROM sales_orders"),
)
def project_rename(t):
    return t.orders().select("order_id", F.col("order_customer_id").alias("customer_id"))


@query(
    "project_period_column",
    statement(
        f"SELECT department_id, department_name, '{DAILY.txn_date}' AS txn_date, "
        f"'{MONTHLY.txn_month}' AS txn_month FROM departments"
    ),
)
def project_period_column(t):
    with_day = periods.with_period(t.departments(), "txn_date", DAILY.txn_date)
    return periods.with_period(with_day, "txn_month", MONTHLY.txn_month)


@query(
    "project_star_plus_dt",
    statement(
        "SELECT order_id, order_date, order_customer_id, order_status, order_date AS dt "
        f"FROM sales_orders WHERE order_date = '{DAILY.txn_date}'"
    ),
)
def project_star_plus_dt(t):
    day = t.orders().drop("dt").where(F.col("order_date") == DAILY.txn_date)
    return periods.with_partition_day(day, DAILY.txn_date)


@query(
    "project_explicit",
    statement(
        "SELECT order_id, order_date, order_customer_id, order_status, dt FROM sales_orders"
    ),
)
def project_explicit(t):
    return scans.select_orders_layout(t.orders())


# --- predicates --------------------------------------------------------------


@query("filter_not_in", statement(f"SELECT * FROM sales_orders WHERE {SALES_ONLY}"))
def filter_not_in(t):
    return t.orders().where(scans.exclude_status(F.col("order_status")))


@query("filter_partition_eq", statement(f"SELECT * FROM sales_orders WHERE {DAY}"))
def filter_partition_eq(t):
    return all_days(t).where(periods.on_day(F.col("dt"), DAILY.txn_date))


@query("filter_month_prefix", statement(f"SELECT * FROM sales_orders WHERE {MONTH}"))
def filter_month_prefix(t):
    return all_days(t).where(periods.in_month(F.col("dt"), MONTHLY))


@query(
    "filter_source_date_eq",
    statement(
        "SELECT order_id, order_date, order_customer_id, order_status FROM sales_orders "
        f"WHERE order_date = '{DAILY.txn_date}'"
    ),
)
def filter_source_date_eq(t):
    return t.reader().read("orders", SourceFilter.equals("order_date", DAILY.txn_date))


@query("filter_and", statement(f"SELECT * FROM sales_orders WHERE {MONTH} AND {SALES_ONLY}"))
def filter_and(t):
    in_month_ = periods.in_month(F.col("dt"), MONTHLY)
    return all_days(t).where(
        in_month_ & scans.exclude_status(F.col("order_status"))
    )


@query(
    "filter_gt_watermark",
    statement(
        "SELECT * FROM order_items WHERE order_item_id > "
        "(SELECT CAST(floor(max(order_item_id) / 2.0) AS BIGINT) FROM order_items)"
    ),
)
def filter_gt_watermark(t):
    items = t.order_items()
    last = items.agg(F.floor(F.max("order_item_id") / 2)).first()[0]
    return items.where(scans.newer_than("order_item_id", last))


# --- joins -------------------------------------------------------------------


@query(
    "join_category_product",
    statement("SELECT * FROM categories JOIN products ON category_id = product_category_id"),
)
def join_category_product(t):
    return facts.join_category_product(t.categories(), t.products())


@query(
    "join_product_items",
    statement(
        "SELECT * FROM order_items JOIN products ON order_item_product_id = product_id "
        "JOIN categories ON product_category_id = category_id"
    ),
)
def join_product_items(t):
    catalog = facts.join_category_product(t.categories(), t.products())
    return facts.join_items(t.order_items(), catalog)


@query(
    "join_items_orders",
    statement(
        "SELECT * FROM order_items JOIN sales_orders ON order_item_order_id = order_id "
        f"WHERE {DAY} AND {SALES_ONLY}"
    ),
)
def join_items_orders(t):
    return facts.join_orders(t.order_items(), day_orders(t))


@query("fact_daily", statement("SELECT * FROM fact", fact=fact(DAY)))
def fact_daily(t):
    return day_fact(t)


@query("fact_monthly", statement("SELECT * FROM fact", fact=fact(MONTH)))
def fact_monthly(t):
    return month_fact(t)


@query(
    "fact_compact",
    statement(
        "SELECT category_id, category_name, category_department_id, customer_id, product_id, "
        f"{PIECES} AS order_item_quantity, {MONEY} AS order_item_subtotal FROM fact GROUP BY ALL",
        fact=fact(DAY),
    ),
)
def fact_compact(t):
    compact = facts.compact_sales_fact(
        day_orders(t), t.order_items(), t.products(), t.categories()
    )
    return compact.withColumn("order_item_subtotal", F.round("order_item_subtotal", MONEY_SCALE))


@query(
    "fact_day_totals",
    statement(
        "SELECT 'product' AS per, product_id, category_id, category_name, "
        f"category_department_id, CAST(NULL AS BIGINT) AS customer_id, {PIECES} AS order_item_quantity, "
        f"{MONEY} AS order_item_subtotal FROM fact "
        "GROUP BY product_id, category_id, category_name, category_department_id "
        f"UNION ALL SELECT 'customer', NULL, NULL, NULL, NULL, customer_id, {PIECES}, {MONEY} "
        "FROM fact GROUP BY customer_id",
        fact=fact(DAY),
    ),
)
def fact_day_totals(t):
    sums = facts.day_totals(day_orders(t), t.order_items(), t.products(), t.categories())
    return sums.withColumn("order_item_subtotal", F.round("order_item_subtotal", MONEY_SCALE))


@query(
    "fact_by_order",
    statement(
        "SELECT customer_id, round(sum(order_item_subtotal), 2) AS order_item_subtotal "
        "FROM fact GROUP BY order_item_order_id, customer_id",
        fact=fact(MONTH),
    ),
)
def fact_by_order(t):
    orders = scans.orders_for_month(t.orders(), MONTHLY)
    by_order = facts.customer_sales_fact(orders, t.order_items(), t.products(), t.categories())
    return by_order.withColumn("order_item_subtotal", F.round("order_item_subtotal", MONEY_SCALE))


@query(
    "join_category_department",
    statement(
        "SELECT s.*, department_name FROM sums s JOIN departments USING (department_id)",
        fact=fact(DAY),
        sums=totals(
            "category_id, category_name, category_department_id AS department_id",
            MONEY,
            "total_sales",
        ),
    ),
)
def join_category_department(t):
    return metrics.enrich(_category_totals(t), t.departments(), "department_id")


@query(
    "join_department_name",
    statement(
        "SELECT s.*, department_name FROM sums s JOIN departments USING (department_id)",
        fact=fact(DAY),
        sums=totals("category_department_id AS department_id", MONEY, "total_sales"),
    ),
)
def join_department_name(t):
    return metrics.enrich(_department_totals(t), t.departments(), "department_id")


@query(
    "join_topqty_product",
    statement(
        "SELECT * FROM top_products_qty_top JOIN products USING (product_id)", **report_ctes(DAILY)
    ),
)
def join_topqty_product(t):
    return metrics.enrich(topk_product_qty(t), t.products(), "product_id", TOP_ROWS)


@query(
    "join_topamt_product",
    statement(
        "SELECT * FROM top_products_amount_top JOIN products USING (product_id)",
        **report_ctes(DAILY),
    ),
)
def join_topamt_product(t):
    return metrics.enrich(topk_product_amount(t), t.products(), "product_id", TOP_ROWS)


@query(
    "join_topcust_customer",
    statement(
        "SELECT * FROM top_customers_day_top JOIN customers USING (customer_id)",
        **report_ctes(DAILY),
    ),
)
def join_topcust_customer(t):
    return metrics.enrich(topk_customer_day(t), t.customers(), "customer_id", TOP_ROWS)


@query(
    "join_topcust_month_customer",
    statement(
        "SELECT * FROM top_customers_month_top JOIN customers USING (customer_id)",
        **report_ctes(MONTHLY),
    ),
)
def join_topcust_month_customer(t):
    return metrics.enrich(topk_customer_month(t), t.customers(), "customer_id", TOP_ROWS)


# --- aggregations ------------------------------------------------------------


def _category_totals(t):
    department = F.col("category_department_id").alias("department_id")
    return metrics.sum_by(
        day_fact(t),
        ["category_id", "category_name", department],
        "order_item_subtotal",
        "total_sales",
        MONEY_SCALE,
    )


def _department_totals(t):
    department = F.col("category_department_id").alias("department_id")
    return metrics.sum_by(
        day_fact(t), [department], "order_item_subtotal", "total_sales", MONEY_SCALE
    )


@query(
    "agg_sales_by_category",
    statement(
        totals(
            "category_id, category_name, category_department_id AS department_id",
            MONEY,
            "total_sales",
        ),
        fact=fact(DAY),
    ),
)
def agg_sales_by_category(t):
    return _category_totals(t)


@query(
    "agg_sales_by_department",
    statement(
        totals("category_department_id AS department_id", MONEY, "total_sales"), fact=fact(DAY)
    ),
)
def agg_sales_by_department(t):
    return _department_totals(t)


@query(
    "agg_qty_by_product",
    statement(totals("product_id", PIECES, "total_qty"), fact=fact(DAY)),
)
def agg_qty_by_product(t):
    return metrics.sum_by(day_fact(t), ["product_id"], "order_item_quantity", "total_qty")


@query(
    "agg_amount_by_product",
    statement(totals("product_id", MONEY, "total_amount"), fact=fact(DAY)),
)
def agg_amount_by_product(t):
    return metrics.sum_by(
        day_fact(t), ["product_id"], "order_item_subtotal", "total_amount", MONEY_SCALE
    )


@query(
    "agg_count_by_status",
    statement(
        "SELECT order_status, count(order_id) AS order_count FROM sales_orders "
        f"WHERE {DAY} GROUP BY order_status"
    ),
)
def agg_count_by_status(t):
    orders = scans.orders_for_day(all_days(t), DAILY.txn_date, all_statuses=True)
    return metrics.count_by(orders, ["order_status"], "order_id", "order_count")


@query(
    "agg_amount_by_customer_day",
    statement(totals("customer_id", MONEY, "total_amount"), fact=fact(DAY)),
)
def agg_amount_by_customer_day(t):
    return metrics.sum_by(
        day_fact(t), ["customer_id"], "order_item_subtotal", "total_amount", MONEY_SCALE
    )


@query(
    "agg_amount_by_customer_month",
    statement(totals("customer_id", MONEY, "total_amount"), fact=fact(MONTH)),
)
def agg_amount_by_customer_month(t):
    return metrics.sum_by(
        month_fact(t), ["customer_id"], "order_item_subtotal", "total_amount", MONEY_SCALE
    )


@query(
    "agg_new_watermark",
    statement("SELECT max(order_item_id) AS last_value FROM order_items"),
)
def agg_new_watermark(t):
    return metrics.new_watermark(t.order_items(), "order_item_id")


# --- top lists ---------------------------------------------------------------


@query(
    "topk_product_qty",
    statement(
        top("sums", "total_qty", "product_id"),
        fact=fact(DAY),
        sums=totals("product_id", PIECES, "total_qty"),
    ),
)
def topk_product_qty(t):
    return metrics.top_k(agg_qty_by_product(t), "product_id", "total_qty", TOP_ROWS)


@query(
    "topk_product_amount",
    statement(
        top("sums", "total_amount", "product_id"),
        fact=fact(DAY),
        sums=totals("product_id", MONEY, "total_amount"),
    ),
)
def topk_product_amount(t):
    return metrics.top_k(agg_amount_by_product(t), "product_id", "total_amount", TOP_ROWS)


@query(
    "topk_customer_day",
    statement(
        top("sums", "total_amount", "customer_id"),
        fact=fact(DAY),
        sums=totals("customer_id", MONEY, "total_amount"),
    ),
)
def topk_customer_day(t):
    return metrics.top_k(agg_amount_by_customer_day(t), "customer_id", "total_amount", TOP_ROWS)


@query(
    "topk_customer_month",
    statement(
        top("sums", "total_amount", "customer_id"),
        fact=fact(MONTH),
        sums=totals("customer_id", MONEY, "total_amount"),
    ),
)
def topk_customer_month(t):
    return metrics.top_k(agg_amount_by_customer_month(t), "customer_id", "total_amount", TOP_ROWS)


# --- functions ---------------------------------------------------------------

SQL_DAY = "CAST(order_date AS DATE)"


def order_day():
    return F.col("order_date").cast("date")


@query(
    "fn_round",
    statement("SELECT order_item_id, round(order_item_subtotal / 7, 2) AS share FROM order_items"),
)
def fn_round(t):
    share = F.round(F.col("order_item_subtotal") / 7, MONEY_SCALE).alias("share")
    return t.order_items().select("order_item_id", share)


@query(
    "fn_date_sub",
    statement(
        "SELECT order_id, CAST(CAST(d - 1 AS DATE) AS VARCHAR) AS day_before, "
        "CAST(CAST(d - 300 AS DATE) AS VARCHAR) AS long_before "
        f"FROM (SELECT order_id, {SQL_DAY} AS d FROM sales_orders)"
    ),
)
def fn_date_sub(t):
    return t.orders().select(
        "order_id",
        F.date_sub(order_day(), 1).cast("string").alias("day_before"),
        F.date_sub(order_day(), 300).cast("string").alias("long_before"),
    )


@query(
    "fn_date_add",
    statement(
        "SELECT order_id, CAST(CAST(d + 64 AS DATE) AS VARCHAR) AS later "
        f"FROM (SELECT order_id, {SQL_DAY} AS d FROM sales_orders)"
    ),
)
def fn_date_add(t):
    return t.orders().select(
        "order_id", F.date_add(order_day(), 64).cast("string").alias("later")
    )


@query(
    "fn_add_months",
    statement(
        "SELECT order_id, CAST(CAST(d - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS month_before "
        f"FROM (SELECT order_id, {SQL_DAY} AS d FROM sales_orders)"
    ),
)
def fn_add_months(t):
    return t.orders().select(
        "order_id", F.add_months(order_day(), -1).cast("string").alias("month_before")
    )


@query(
    "fn_month_prefix",
    statement("SELECT order_id, substr(dt, 1, 7) AS order_month FROM sales_orders"),
)
def fn_month_prefix(t):
    return t.orders().select("order_id", periods.month_prefix(F.col("dt")).alias("order_month"))


@query(
    "fn_epoch_shift",
    statement(
        "SELECT order_id, CAST(epoch(d) AS BIGINT) AS seconds, "
        "strftime(d - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before "
        f"FROM (SELECT order_id, {SQL_DAY} AS d FROM sales_orders)"
    ),
)
def fn_epoch_shift(t):
    seconds = periods.epoch_seconds(order_day())
    day_before = periods.day_label(periods.day_from_epoch(seconds, 1))
    return t.orders().select(
        "order_id", seconds.alias("seconds"), day_before.alias("day_before")
    )


@query(
    "fn_date_format",
    statement(
        f"SELECT order_id, strftime({SQL_DAY}, '%Y-%m-%d') AS day_label, "
        f"strftime({SQL_DAY}, '%Y-%m') AS month_label FROM sales_orders"
    ),
)
def fn_date_format(t):
    return t.orders().select(
        "order_id",
        periods.day_label(order_day()).alias("day_label"),
        periods.month_label(order_day()).alias("month_label"),
    )


@query(
    "fn_period_values",
    statement(
        "SELECT order_id, '2000-02-03' AS txn_date, '2000-01' AS txn_month, "
        "dt = '2000-02-03' AS in_day, substr(dt, 1, 7) = '2000-01' AS in_month, "
        "substr(dt, 9, 2) = '01' AS is_month_start FROM sales_orders"
    ),
)
def fn_period_values(t):
    dt = F.col("dt")
    return t.orders().select(
        "order_id",
        F.lit(DAILY.txn_date).alias("txn_date"),
        F.lit(DAILY.txn_month).alias("txn_month"),
        periods.on_day(dt, DAILY.txn_date).alias("in_day"),
        periods.in_month(dt, DAILY).alias("in_month"),
        (F.dayofmonth(dt.cast("date")) == 1).alias("is_month_start"),
    )


@query(
    "fn_sink_casts",
    statement(
        "SELECT CAST(product_id AS INTEGER) AS product_id, product_name, "
        "CAST(sum(order_item_quantity) AS DOUBLE) AS total_qty "
        "FROM order_items JOIN products ON order_item_product_id = product_id GROUP BY ALL"
    ),
)
def fn_sink_casts(t):
    sums = metrics.sum_by(
        t.order_items(),
        [F.col("order_item_product_id").alias("product_id")],
        "order_item_quantity",
        "total_qty",
    )
    named = metrics.enrich(sums, t.products(), "product_id")
    return cast_to_sink(named, REPORT_TABLES["top_products_qty"].columns)


# --- date rebase -------------------------------------------------------------

ANCHOR = date(2004, 2, 4)
SOURCE_LAYOUT = [c for c in MODEL["orders"].names if c != "dt"]
REBASED = (
    "SELECT order_id, "
    f"CASE WHEN DATE '{ANCHOR}' - {SQL_DAY} BETWEEN 2915 AND 3279 "
    f"THEN CAST(CAST({SQL_DAY} + 2979 AS DATE) AS VARCHAR) ELSE order_date END AS order_date, "
    "order_customer_id, order_status FROM sales_orders"
)


@query("rebase_order_dates", statement("SELECT * FROM rebased", rebased=REBASED))
def rebase_order_dates_(t):
    return rebase_order_dates(t.source_orders(), ANCHOR).select(*SOURCE_LAYOUT)


@query(
    "max_order_date",
    statement("SELECT max(order_date) AS max_order_date FROM rebased", rebased=REBASED),
)
def max_order_date_(t):
    return max_order_date(rebase_order_dates(t.source_orders(), ANCHOR))
