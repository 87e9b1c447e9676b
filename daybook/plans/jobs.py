"""Jobs: the daily run, the first run, and reports alone."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from daybook.context import RunContext
from daybook.operators.facts import JoinAudit, day_totals, per_customer, per_product
from daybook.operators.scans import in_order_range, order_bounds, orders_for_day
from daybook.plans import reports
from daybook.plans.kept import keep_day, month_customer_sums
from daybook.schemas import REPORT_TABLES, SNAPSHOT_KEYS
from daybook.session import create_scratch_database, drop_scratch_database, shared_dir
from daybook.sinks.kept import KeptDay
from daybook.sinks.publish import Publication
from daybook.sinks.runs import RunLedger
from daybook.sinks.tables import database_exists, ensure_database, qualified
from daybook.sources.appended import band_width, committed_rows, compact, last_commit
from daybook.sources.ingest import import_orders_day, incremental_append, snapshot_import
from daybook.sources.readers import Reader, RebasingReader

# Fixed value: the ledger's step of showing the reports.
PUBLISHED = "publish reports"
# A named action, giving the number of rows it wrote where it counts them.
Step = tuple[str, Callable[[], int | None]]


@dataclass(frozen=True)
class JobConfig:
    """Where a run reads and writes.

    ``import_tasks`` is the number of parallel reads per source table, and
    ``concurrent_steps`` the number of independent tables imported or reports
    written at a time; their product bounds the connections to the source.
    ``rebase_anchor`` moves historic order dates of the source relative to that
    day; it belongs to the source, so every run against it uses the same one.
    """

    database: str
    reader: Reader | None = None
    lag_days: int = 1
    import_tasks: int = 2
    concurrent_steps: int = 6
    rebase_anchor: date | None = None
    database_location: str | None = None

    def source(self) -> Reader:
        if self.reader is None:
            raise ValueError("this job imports and needs a reader")
        if self.rebase_anchor is None:
            return self.reader
        return RebasingReader(self.reader, self.rebase_anchor)


def _together(
    spark: SparkSession, steps: Iterable[Step], at_once: int, ledger: RunLedger | None = None
) -> dict[str, int | None]:
    """Run independent actions from several threads, so small ones share the cluster.

    A step starts as soon as ``steps`` yields it, unless the ledger has it as finished.
    All started ones end before the first failure, if any, is raised.
    """

    def noted(name: str, action: Callable[[], int | None]) -> Callable[[], int | None]:
        def act() -> int | None:
            rows = action()
            ledger.finish(name, rows)
            return rows

        return action if ledger is None else act

    with ThreadPoolExecutor(at_once) as pool:
        started = {
            name: None
            if ledger is not None and ledger.finished(name)
            else pool.submit(inheritable_thread_target(spark)(noted(name, action)))
            for name, action in steps
        }
    return {
        name: ledger.rows(name) if future is None else future.result()
        for name, future in started.items()
    }


def _import(
    spark: SparkSession, config: JobConfig, ctx: RunContext, mode: str, ledger: RunLedger
) -> None:
    reader, database, tasks = config.source(), config.database, config.import_tasks
    steps: list[Step] = [
        ("orders", lambda: import_orders_day(spark, reader, database, ctx.txn_date, tasks)),
        ("order_items", lambda: incremental_append(spark, reader, database, tasks=tasks)),
    ]
    for table in SNAPSHOT_KEYS:
        steps.append(
            (table, partial(snapshot_import, spark, reader, database, table, mode, tasks))
        )
    named = [(f"import {name}", action) for name, action in steps]
    _together(spark, named, config.concurrent_steps, ledger)


def run_daily(spark: SparkSession, config: JobConfig, run_date: date) -> dict[str, int]:
    """Refresh the snapshots, load one day of orders and the new items, write all reports.

    A run of this date that stopped goes on: imports and reports that it finished are
    not done again.
    """
    shared_dir(spark)  # fails before anything is read
    ctx = RunContext(run_date, config.lag_days)
    ledger = RunLedger(spark, config.database, run_date.isoformat())
    _import(spark, config, ctx, "overwrite", ledger)
    compact(spark, config.database)
    written = run_reports(spark, config, run_date, ledger)
    ledger.close()
    return written


def run_bootstrap(spark: SparkSession, config: JobConfig, run_date: date) -> dict[str, int]:
    """First run: create the database and its tables, import, write all reports.

    The items stay loaded and their high-water mark stays at the newest id, so
    the next daily run adds only what is new.
    """
    shared_dir(spark)
    ctx = RunContext(run_date, config.lag_days)
    ensure_database(spark, config.database, config.database_location)
    ledger = RunLedger(spark, config.database, run_date.isoformat())
    _import(spark, config, ctx, "create", ledger)
    written = run_reports(spark, config, run_date, ledger)
    ledger.close()
    return written


def run(spark: SparkSession, config: JobConfig, run_date: date) -> dict[str, int]:
    """Daily run if the warehouse exists, first run otherwise; a failed step raises."""
    if database_exists(spark, config.database):
        return run_daily(spark, config, run_date)
    return run_bootstrap(spark, config, run_date)


def run_reports(
    spark: SparkSession, config: JobConfig, run_date: date, ledger: RunLedger | None = None
) -> dict[str, int]:
    """Write every report due on ``run_date`` from the warehouse; rows written per report.

    All become visible together, after the last one has been written; if one fails, none
    does. With a ledger, a run whose reports are visible already does not write them again.
    """
    if ledger is not None and ledger.finished(PUBLISHED):
        return {name: ledger.rows(name) for name in REPORT_TABLES if ledger.finished(name)}
    ctx = RunContext(run_date, config.lag_days)
    scratch = create_scratch_database(spark)
    publication = Publication(spark, config.database)
    try:
        steps = _report_steps(spark, config.database, ctx, scratch, publication)
        written = _together(spark, steps, config.concurrent_steps)
    except BaseException:
        publication.discard()
        raise
    finally:
        drop_scratch_database(spark, scratch)
    publication.publish()
    if ledger is not None:
        ledger.finish_all({**written, PUBLISHED: None})
    return written


def _report_steps(
    spark: SparkSession, database: str, ctx: RunContext, scratch: str, publication: Publication
) -> Iterator[Step]:
    """Writes of the reports due; the monthly one only on the first of a month.

    The one that does not need the fact of the day comes first and runs while it is
    built. The day's sums are kept for the monthly report.
    """
    periods = {"txn_date": ctx.txn_date, "txn_month": ctx.txn_month}

    def table(name: str) -> DataFrame:
        return spark.table(qualified(database, name))

    def step(name: str, build: Callable[..., DataFrame], *inputs: DataFrame) -> Step:
        period = periods[REPORT_TABLES[name].period_column]
        return name, lambda: publication.stage(build(*inputs, ctx), name, period)

    orders, products = table("orders"), table("products")
    mark = last_commit(spark, database, "order_items").last_value
    items = committed_rows(spark, database, "order_items")
    width = band_width(spark, database, "order_items")
    categories, departments, customers = (
        table("categories"), table("departments"), table("customers")
    )

    every_order = orders_for_day(orders, ctx.txn_date, all_statuses=True)
    yield step("order_status", reports.order_status, every_order)

    sales, audit = orders_for_day(orders, ctx.txn_date), JoinAudit()
    low, high = order_bounds(sales)
    sold = in_order_range(items, low, high, width)
    totals = _store(
        day_totals(sales, sold, products, categories, audit), qualified(scratch, "day_totals")
    )
    fact, spent = per_product(totals), per_customer(totals)
    yield step("category_sales", reports.category_sales, fact, departments)
    yield step("department_sales", reports.department_sales, fact, departments)
    yield step("top_products_qty", reports.top_products_qty, fact, products)
    yield step("top_products_amount", reports.top_products_amount, fact, products)
    yield step("top_customers_day", reports.top_customers_day, spent, customers)

    # While those are written, the day is kept; the month may end with it.
    # Spark skips the joins, and with them the counts, where it finds an input empty.
    counted = {} if totals.isEmpty() else audit.rows()
    keep_day(spark, database, KeptDay(ctx.txn_date, mark, low, high, **counted), totals)
    if ctx.is_month_start:

        def top_customers_month(*_) -> DataFrame:
            fact = month_customer_sums(spark, database, ctx)
            return reports.top_customers_month(fact, customers, ctx)

        yield step("top_customers_month", top_customers_month)


def _store(df: DataFrame, table: str) -> DataFrame:
    """Write a frame once to shared storage and read it from there.

    Five reports read it, and a lost executor does not make the item scan run again.
    """
    df.write.format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)
