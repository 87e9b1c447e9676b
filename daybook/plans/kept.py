"""The monthly report from daily sums that are kept, and rebuilt where they went stale.

The daily job keeps what each customer spent. A month is then the sum of some thirty
small partitions. Before that every day is checked: sums go stale when orders of the
day are imported again (the import removes the day from the ledger), when items of its
orders arrive later, and when the catalog has changed in a way that matters to it.
Missing and stale days are built from the items again, and kept.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import timedelta
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.context import RunContext
from daybook.operators.facts import customer_day_sums, per_customer, per_product
from daybook.operators.scans import in_order_range, orders_for_month
from daybook.sinks.kept import (
    CUSTOMER_SUMS,
    PRODUCT_SUMS,
    KeptDay,
    forget_days,
    keep_days,
    keep_sums,
    kept_days,
    kept_table,
    write_ledger,
)
from daybook.sinks.tables import qualified
from daybook.sources.appended import band_width, committed_rows, last_commit


def catalog_fingerprint(products: DataFrame, categories: DataFrame) -> str:
    """Number and hash of the products that have a category, with repeats; order does not matter."""
    known = _with_category(products, categories)
    hashed = F.sum(F.xxhash64("product_id").cast("decimal(38,0)"))
    count, total = known.agg(F.count(F.lit(1)), hashed).first()
    return f"{count}:{total}"


def _with_category(products: DataFrame, categories: DataFrame) -> DataFrame:
    same = F.col("product_category_id") == F.col("category_id")
    return products.join(categories.select("category_id"), same).select("product_id")


def keep_day(spark: SparkSession, database: str, day: KeptDay, totals: DataFrame) -> None:
    """Keep the sums of one day, from the totals that its reports were made from."""
    products, categories = (spark.table(qualified(database, t)) for t in ("products", "categories"))
    forget_days(spark, database, [day.dt])
    sums = {CUSTOMER_SUMS: per_customer(totals), PRODUCT_SUMS: per_product(totals)}
    with ThreadPoolExecutor(3) as pool:  # small actions, none of which needs another
        own = inheritable_thread_target(spark)
        catalog = pool.submit(own(catalog_fingerprint), products, categories)
        kept = [pool.submit(own(keep_sums), df, database, name, day.dt) for name, df in sums.items()]
    for future in kept:
        future.result()
    write_ledger(spark, database, [replace(day, catalog=catalog.result())])


def days_of_month(ctx: RunContext) -> list[str]:
    count = (ctx.month_end_excl - ctx.month_start).days
    return [(ctx.month_start + timedelta(days=i)).isoformat() for i in range(count)]


def month_customer_sums(spark: SparkSession, database: str, ctx: RunContext) -> DataFrame:
    """(customer_id, order_item_subtotal) of the month before the run date, by day and customer.

    Reads items only for days whose sums are missing or stale, and keeps what it builds.
    """
    days = days_of_month(ctx)
    kept = kept_days(spark, database, days[0], ctx.month_end_excl.isoformat())
    stale = _stale_days(spark, database, ctx, kept)
    build = [day for day in days if day not in kept or day in stale]
    if build:
        _build_days(spark, database, ctx, build)
    sums = spark.table(kept_table(spark, database, CUSTOMER_SUMS))
    month = F.col("dt").between(days[0], days[-1])
    return sums.where(month).select("customer_id", "order_item_subtotal")


def _stale_days(
    spark: SparkSession, database: str, ctx: RunContext, kept: dict[str, KeptDay]
) -> set[str]:
    if not kept:
        return set()
    return _changed_catalog(spark, database, kept) | _late_items(spark, database, ctx, kept)


def _changed_catalog(spark: SparkSession, database: str, kept: dict[str, KeptDay]) -> set[str]:
    """Days that sold a product which now counts otherwise, or might have.

    A new product changes no day whose items all had one. Of such days, the products
    sold are compared with the catalog; other days are stale after any change.
    """
    products, categories = (spark.table(qualified(database, t)) for t in ("products", "categories"))
    now = catalog_fingerprint(products, categories)
    changed = [day for day, row in kept.items() if row.catalog != now]
    certain = {day for day in changed if not kept[day].complete}
    compare = [day for day in changed if day not in certain]
    if not compare:
        return certain
    sold = spark.table(kept_table(spark, database, PRODUCT_SUMS)).where(F.col("dt").isin(compare))
    counted = sold.groupBy("dt", "product_id").agg(F.count(F.lit(1)).alias("then"))
    today = _with_category(products, categories).groupBy("product_id").agg(F.count(F.lit(1)).alias("now"))
    differ = counted.join(today, "product_id", "left").where(~F.col("then").eqNullSafe(F.col("now")))
    return certain | {row["dt"] for row in differ.select("dt").distinct().collect()}


def _late_items(
    spark: SparkSession, database: str, ctx: RunContext, kept: dict[str, KeptDay]
) -> set[str]:
    """Days whose orders have items beyond the mark that the day was summed at.

    The ranges of item and order ids are literals, so directories and row groups without
    such items are not read; what is left meets the orders of those days.
    """
    items = committed_rows(spark, database, "order_items")
    width = band_width(spark, database, "order_items")
    newest = last_commit(spark, database, "order_items").last_value
    open_days = [d for d in kept.values() if d.low is not None and d.items_mark < newest]
    if not open_days:
        return set()

    def late(day: KeptDay) -> Column:
        newer = F.col("order_item_id") > day.items_mark
        return newer & F.col("order_item_order_id").between(day.low, day.high)

    low, high = min(d.low for d in open_days), max(d.high for d in open_days)
    candidates = in_order_range(items, low, high, width).where(reduce(Column.__or__, map(late, open_days)))
    marks = spark.createDataFrame([(d.dt, d.items_mark) for d in open_days], "dt string, mark long")
    orders = orders_for_month(spark.table(qualified(database, "orders")), ctx)
    orders = orders.where(F.col("dt").isin([d.dt for d in open_days])).select("dt", "order_id")
    met = candidates.select("order_item_id", "order_item_order_id").join(
        orders, F.col("order_item_order_id") == F.col("order_id")
    )
    newer = met.join(F.broadcast(marks), "dt").where("order_item_id > mark")  # at most 31 rows
    return {row["dt"] for row in newer.select("dt").distinct().collect()}


def _build_days(spark: SparkSession, database: str, ctx: RunContext, days: list[str]) -> None:
    """Sum the items of these days by customer, keep that, and enter them in the ledger."""
    forget_days(spark, database, days)
    mark = last_commit(spark, database, "order_items").last_value
    items = committed_rows(spark, database, "order_items")
    products, categories = (spark.table(qualified(database, t)) for t in ("products", "categories"))
    orders = orders_for_month(spark.table(qualified(database, "orders")), ctx)
    orders = orders.where(F.col("dt").isin(days))
    # At most one row per day of a month.
    found = orders.groupBy("dt").agg(F.min("order_id"), F.max("order_id")).collect()
    bounds = {dt: (low, high) for dt, low, high in found}
    if bounds:
        low, high = min(b[0] for b in bounds.values()), max(b[1] for b in bounds.values())
        some = in_order_range(items, low, high, band_width(spark, database, "order_items"))
        sums = customer_day_sums(orders, some, products, categories)
        keep_days(sums, database, CUSTOMER_SUMS, days)
    catalog = catalog_fingerprint(products, categories)
    none = (None, None)
    write_ledger(
        spark, database, [KeptDay(day, mark, *bounds.get(day, none), catalog=catalog) for day in days]
    )
