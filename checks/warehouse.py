"""Operators that write tables: run on a scratch database, then read back."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.basic import ANCHOR, BACKFILL_TASKS, REBASED
from checks.oracle import LONG_COLUMNS, in_day, long_form, report, report_ctes, statement
from checks.registry import DAILY, MONTHLY, query
from daybook.context import RunContext
from daybook.operators.facts import sales_fact
from daybook.operators.scans import orders_for_day
from daybook.plans import jobs, reports
from daybook.schemas import REPORT_TABLES
from daybook.session import create_scratch_database, shared_dir
from daybook.sinks import tables
from daybook.sources import appended, ingest
from daybook.sources.readers import FrameReader, RangeReader, SourceFilter, Split
from daybook.sources.samples import SampleTables

DAILY_REPORTS = [name for name in REPORT_TABLES if name != "top_customers_month"]
# Two more reported days, used to check that other periods stay untouched.
NEXT_DAY = RunContext(DAILY.run_date + timedelta(days=1))
DAY_ORDERS = f"SELECT * FROM sales_orders WHERE {in_day(DAILY)}"


def department_report(t: SampleTables, ctx: RunContext) -> DataFrame:
    fact = sales_fact(
        orders_for_day(t.orders(), ctx.txn_date),
        t.order_items(),
        t.products(),
        t.categories(),
    )
    return reports.department_sales(fact, t.departments(), ctx)


# --- ingestion ---------------------------------------------------------------


def _snapshot(t: SampleTables, table: str) -> DataFrame:
    database = create_scratch_database(t.spark)
    ingest.snapshot_import(t.spark, t.reader(), database, table)
    return t.spark.table(tables.qualified(database, table))


@query("import_snapshot_categories", statement("SELECT * FROM categories"))
def import_snapshot_categories(t):
    return _snapshot(t, "categories")


@query("import_snapshot_departments", statement("SELECT * FROM departments"))
def import_snapshot_departments(t):
    return _snapshot(t, "departments")


@query("import_snapshot_products", statement("SELECT * FROM products"))
def import_snapshot_products(t):
    return _snapshot(t, "products")


@query("import_snapshot_customers", statement("SELECT * FROM customers"))
def import_snapshot_customers(t):
    return _snapshot(t, "customers")


@query("import_orders_day", statement(DAY_ORDERS))
def import_orders_day(t):
    database = create_scratch_database(t.spark)
    ingest.import_orders_day(t.spark, t.reader(), database, DAILY.txn_date)
    return t.spark.table(tables.qualified(database, "orders"))


def _grow(t: SampleTables) -> tuple[FrameReader, FrameReader]:
    """The source as it was when half of the item ids existed, and as it is now."""
    now = _wide_reader(t)
    items = now.frames["order_items"]
    middle = items.agg(F.floor(F.max("order_item_id") / 2)).first()[0]
    before = {**now.frames, "order_items": items.where(F.col("order_item_id") <= middle)}
    return replace(now, frames=before), now


WIDE_ITEMS = "SELECT *, order_item_subtotal / order_item_quantity AS order_item_product_price FROM order_items"


def _wide_reader(t: SampleTables) -> FrameReader:
    """The source with an item column that the model does not have."""
    source = t.reader()
    price = F.col("order_item_subtotal") / F.col("order_item_quantity")
    items = source.frames["order_items"].withColumn("order_item_product_price", price)
    return replace(source, frames={**source.frames, "order_items": items})


@query(
    "import_incremental_append",
    statement(
        f"SELECT *, (SELECT max(order_item_id) FROM order_items) AS last_value FROM ({WIDE_ITEMS})"
    ),
)
def import_incremental_append(t):
    database = create_scratch_database(t.spark)
    before, now = _grow(t)
    ingest.incremental_append(t.spark, before, database)
    ingest.incremental_append(t.spark, now, database)
    ingest.incremental_append(t.spark, now, database)  # nothing new
    last = ingest.saved_watermark(t.spark, database, "order_items")
    rows = appended.imported(t.spark, database)
    return rows.withColumn("last_value", F.lit(last).cast("bigint"))


@query("import_partitioned_read", statement(f"SELECT order_id, order_status FROM ({DAY_ORDERS})"))
def import_partitioned_read(t):
    """Fails if the split does not give two tasks, each with nearly half of the rows."""
    source = RangeReader(t.reader().frames)
    day = SourceFilter.equals("order_date", DAILY.txn_date)
    shares = [part.count() for part in source.parts("orders", day, Split("order_id", 2))]
    if len(shares) != 2 or max(shares) - min(shares) > 0.05 * sum(shares) + 1:
        raise ValueError(f"tasks of the split read have {shares} rows")
    return ingest.read_orders_day(source, DAILY.txn_date, tasks=2).select("order_id", "order_status")


@query(
    "import_create_mode", statement("SELECT *, true AS second_create_refused FROM categories")
)
def import_create_mode(t):
    database = create_scratch_database(t.spark)
    ingest.snapshot_import(t.spark, t.reader(), database, "categories", mode="create")
    try:
        ingest.snapshot_import(t.spark, t.reader(), database, "categories", mode="create")
        refused = False
    except ingest.TableExistsError:
        refused = True
    rows = t.spark.table(tables.qualified(database, "categories"))
    return rows.withColumn("second_create_refused", F.lit(refused))


@query("import_overwrite_idempotent", statement("SELECT * FROM customers"))
def import_overwrite_idempotent(t):
    database = create_scratch_database(t.spark)
    ingest.snapshot_import(t.spark, t.reader(), database, "customers")
    ingest.snapshot_import(t.spark, t.reader(), database, "customers")
    return t.spark.table(tables.qualified(database, "customers"))


@query("import_reset_reload", statement(WIDE_ITEMS))
def import_reset_reload(t):
    database = create_scratch_database(t.spark)
    ingest.incremental_append(t.spark, _wide_reader(t), database)
    ingest.reset_incremental(t.spark, database)
    ingest.incremental_append(t.spark, _wide_reader(t), database)
    return appended.imported(t.spark, database)


@query(
    "orders_dynamic_overwrite",
    statement(
        "SELECT order_id, order_date, order_customer_id, "
        f"CASE WHEN {in_day(DAILY)} THEN 'CLOSED' ELSE order_status END AS order_status, dt "
        "FROM sales_orders"
    ),
)
def orders_dynamic_overwrite(t):
    database = create_scratch_database(t.spark)
    ingest.load_orders_partitions(t.spark, t.orders(), database, BACKFILL_TASKS)
    changed = t.orders_on(DAILY).withColumn("order_status", F.lit("CLOSED"))
    ingest.load_orders_partitions(t.spark, changed, database)
    return t.spark.table(tables.qualified(database, "orders"))


# --- tables and partitions ---------------------------------------------------


def _absent_database(t: SampleTables) -> tuple[str, str]:
    """Name and folder of a database that does not exist."""
    name = f"daybook_new_{uuid.uuid4().hex}"
    return name, f"{shared_dir(t.spark)}/{name}"


@query("ddl_create_database", statement("SELECT * FROM departments"))
def ddl_create_database(t):
    database, folder = _absent_database(t)
    tables.ensure_database(t.spark, database, folder)
    tables.ensure_database(t.spark, database, folder)  # exists already: no error, nothing lost
    ingest.snapshot_import(t.spark, t.reader(), database, "departments")
    tables.ensure_database(t.spark, database)
    return t.spark.table(tables.qualified(database, "departments"))


@query(
    "ddl_database_exists",
    statement("SELECT *, true AS present, false AS present_under_other_name FROM departments"),
)
def ddl_database_exists(t):
    database = create_scratch_database(t.spark)
    ingest.snapshot_import(t.spark, t.reader(), database, "departments")
    present = tables.database_exists(t.spark, database)
    other = tables.database_exists(t.spark, f"{database}_other")
    rows = t.spark.table(tables.qualified(database, "departments"))
    return rows.select(
        "*", F.lit(present).alias("present"), F.lit(other).alias("present_under_other_name")
    )


@query("ddl_create_orders", statement("SELECT * FROM sales_orders"))
def ddl_create_orders(t):
    database = create_scratch_database(t.spark)
    table = tables.ensure_orders_table(t.spark, database)
    rows = t.orders().repartitionByRange(BACKFILL_TASKS, "dt", "order_id")
    tables.insert_partitions(rows, table, t.spark.table(table).columns)
    tables.ensure_orders_table(t.spark, database)
    return t.spark.table(table)


@query("ddl_create_report", report("department_sales", DAILY))
def ddl_create_report(t):
    database = create_scratch_database(t.spark)
    for name in REPORT_TABLES:
        tables.ensure_report_table(t.spark, database, name)
    table = tables.ensure_report_table(t.spark, database, "department_sales")
    rows = department_report(t, DAILY)
    tables.insert_partitions(rows, table, REPORT_TABLES["department_sales"].column_names)
    return t.spark.table(table)


def _two_days(t: SampleTables) -> str:
    """Scratch report table holding department sales of two days."""
    database = create_scratch_database(t.spark)
    table = tables.ensure_report_table(t.spark, database, "department_sales")
    both = department_report(t, DAILY).unionByName(department_report(t, NEXT_DAY))
    tables.insert_partitions(both, table, REPORT_TABLES["department_sales"].column_names)
    return table


BOTH_DAYS = statement(
    "SELECT * FROM department_sales UNION ALL SELECT * FROM next_department_sales",
    **report_ctes(DAILY),
    **report_ctes(NEXT_DAY, prefix="next_"),
)


@query("sink_drop_partition", report("department_sales", NEXT_DAY))
def sink_drop_partition(t):
    table = _two_days(t)
    tables.drop_partition(t.spark, table, "txn_date", DAILY.txn_date)
    tables.drop_partition(t.spark, table, "txn_date", DAILY.txn_date)  # absent: no error
    return t.spark.table(table)


@query("sink_insert_dynamic", BOTH_DAYS)
def sink_insert_dynamic(t):
    return t.spark.table(_two_days(t))


@query("sink_replace_period", BOTH_DAYS)
def sink_replace_period(t):
    table = _two_days(t)
    for _ in range(2):
        rows = department_report(t, DAILY)
        tables.replace_period(rows, table, "txn_date", DAILY.txn_date)
    return t.spark.table(table)


@query("sink_replace_period_empty", report("department_sales", NEXT_DAY))
def sink_replace_period_empty(t):
    table = _two_days(t)
    nothing = department_report(t, DAILY).where(F.col("total_sales").isNull())
    tables.replace_period(nothing, table, "txn_date", DAILY.txn_date)
    return t.spark.table(table)


# --- jobs --------------------------------------------------------------------


def _long_form(t: SampleTables, database: str, names: list[str]) -> DataFrame:
    """Rows of several report tables in one layout."""

    def rows(name: str) -> DataFrame:
        layout = REPORT_TABLES[name]
        entity, label, value = LONG_COLUMNS[name]
        return t.spark.table(tables.qualified(database, layout.name)).select(
            F.lit(name).alias("report"),
            F.col(layout.period_column).alias("period"),
            F.col(entity).cast("string").alias("entity"),
            F.col(label).alias("label"),
            F.col(value).cast("double").alias("value"),
        )

    return reduce(DataFrame.unionByName, [rows(name) for name in names])


TWO_RUNS = statement(
    f"{long_form(DAILY_REPORTS)} UNION ALL {long_form(DAILY_REPORTS, prefix='next_')}",
    **report_ctes(DAILY),
    **report_ctes(NEXT_DAY, prefix="next_"),
)


@query("job_daily", TWO_RUNS)
def job_daily(t):
    config = jobs.JobConfig(create_scratch_database(t.spark), t.reader())
    for ctx in (DAILY, NEXT_DAY, DAILY):  # the repeated day changes nothing
        jobs.run_daily(t.spark, config, ctx.run_date)
    return _long_form(t, config.database, DAILY_REPORTS)


@query("job_run", TWO_RUNS)
def job_run(t):
    """A first and a daily run, told apart by the job itself."""
    database, folder = _absent_database(t)
    config = jobs.JobConfig(database, t.reader(), database_location=folder)
    for ctx in (DAILY, NEXT_DAY):
        jobs.run(t.spark, config, ctx.run_date)
    return _long_form(t, config.database, DAILY_REPORTS)


FIRST_RUN = RunContext(ANCHOR)


@query(
    "job_bootstrap",
    statement(
        long_form(DAILY_REPORTS),
        rebased=REBASED,
        rebased_orders="SELECT *, order_date AS dt FROM rebased",
        **report_ctes(FIRST_RUN, orders="rebased_orders"),
    ),
)
def job_bootstrap(t):
    database, folder = _absent_database(t)
    config = jobs.JobConfig(
        database, t.reader(), rebase_anchor=ANCHOR, database_location=folder
    )
    jobs.run_bootstrap(t.spark, config, FIRST_RUN.run_date)
    return _long_form(t, database, DAILY_REPORTS)


def loaded_warehouse(t: SampleTables) -> jobs.JobConfig:
    """A warehouse with all orders and everything else imported."""
    config = jobs.JobConfig(create_scratch_database(t.spark), t.reader())
    ingest.load_orders_partitions(t.spark, t.orders(), config.database, BACKFILL_TASKS)
    for table in ingest.SNAPSHOT_KEYS:
        ingest.snapshot_import(t.spark, config.reader, config.database, table)
    ingest.incremental_append(t.spark, config.reader, config.database)
    return config


@query("job_reports_only", statement(long_form(DAILY_REPORTS), **report_ctes(DAILY)))
def job_reports_only(t):
    config = loaded_warehouse(t)
    jobs.run_reports(t.spark, config, DAILY.run_date)
    return _long_form(t, config.database, DAILY_REPORTS)


@query(
    "job_month_gate",
    statement(
        "SELECT *, false AS written_on_second FROM top_customers_month", **report_ctes(MONTHLY)
    ),
)
def job_month_gate(t):
    config = loaded_warehouse(t)
    second = date(MONTHLY.run_date.year, MONTHLY.run_date.month, 2)
    written = jobs.run_reports(t.spark, config, second)
    jobs.run_reports(t.spark, config, MONTHLY.run_date)
    layout = REPORT_TABLES["top_customers_month"]
    rows = t.spark.table(tables.qualified(config.database, layout.name))
    return rows.withColumn("written_on_second", F.lit("top_customers_month" in written))
