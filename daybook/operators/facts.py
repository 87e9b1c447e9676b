"""The sales fact: categories, products, order items and orders joined.

All joins are inner equi-joins. Items meet the selective side, one period of
orders, first. No join carries a broadcast hint: Spark broadcasts a side when
its size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
shuffles, with adaptive execution splitting keys that hold very many rows. The
right side of every join is a plain table, whose size Spark knows exactly; the
size of a join result it would guess, far too high.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# Columns the reports need; the rest of the fact is read by nobody.
REPORT_COLUMNS = (
    "category_id",
    "category_name",
    "category_department_id",
    "customer_id",
    "product_id",
    "order_item_quantity",
    "order_item_subtotal",
)


def join_category_product(categories: DataFrame, products: DataFrame) -> DataFrame:
    return products.join(
        categories, products.product_category_id == categories.category_id, "inner"
    )


def join_items(items: DataFrame, products: DataFrame) -> DataFrame:
    return items.join(products, F.col("order_item_product_id") == F.col("product_id"), "inner")


def join_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    return items.join(orders, F.col("order_item_order_id") == F.col("order_id"), "inner")


def sales_fact(
    orders: DataFrame, items: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    """One row per sold item: all category columns, customer, product, all item columns."""
    sold = join_orders(items.alias("oi"), orders.alias("o"))
    with_product = join_items(sold, products.alias("p"))
    joined = with_product.join(
        categories.alias("c"), F.col("p.product_category_id") == F.col("c.category_id"), "inner"
    )
    return select_fact_columns(joined)


def select_fact_columns(joined: DataFrame) -> DataFrame:
    """Stars of two sides beside single, renamed columns of the other two."""
    return joined.select(
        "c.*", F.col("o.order_customer_id").alias("customer_id"), "p.product_id", "oi.*"
    )


def compact_sales_fact(
    orders: DataFrame, items: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    """The fact summed to one row per product and customer, for the report columns.

    Every report only sums quantity or subtotal, so it gives the same result on
    this frame as on the row-level fact. Map-side partial sums collapse hot
    products and customers before the first wide shuffle, and a product without
    a small catalog to broadcast meets its catalog row after that.
    """
    sums = (
        join_orders(items, orders)
        .groupBy(
            F.col("order_item_product_id"), F.col("order_customer_id").alias("customer_id")
        )
        .agg(
            F.sum("order_item_quantity").alias("order_item_quantity"),
            F.sum("order_item_subtotal").alias("order_item_subtotal"),
        )
    )
    with_product = join_items(sums, products)
    return with_product.join(
        categories, F.col("product_category_id") == F.col("category_id"), "inner"
    ).select(*REPORT_COLUMNS)


@dataclass(frozen=True)
class JoinAudit:
    """Counts of the rows that come out of each inner join of a pass, made on the way.

    What a lookup loses is the count before it minus the count after. An executor lost
    on the way can make a count too large, never too small. The counts are there once
    the frame has been written and has rows.
    """

    sold: Observation = field(default_factory=Observation)
    with_product: Observation = field(default_factory=Observation)
    with_category: Observation = field(default_factory=Observation)

    def rows(self) -> dict[str, int]:
        return {name: getattr(self, name).get["rows"] for name in self.__dataclass_fields__}


NO_AUDIT = JoinAudit(None, None, None)


def _counted(df: DataFrame, observation: Observation | None) -> DataFrame:
    return df if observation is None else df.observe(observation, F.count(F.lit(1)).alias("rows"))


def day_totals(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    audit: JoinAudit | None = None,
) -> DataFrame:
    """The fact summed twice in one pass: per product and per customer.

    ``per`` tells the two kinds of rows apart. Partial sums in the map tasks bound
    the shuffle by tasks times distinct products and customers, however many items
    there are. The grouping does not follow the partitioning of any join before it,
    so adaptive execution is free to split a hot order or product there.
    """
    seen = audit or NO_AUDIT
    sold = _counted(join_orders(items, orders), seen.sold)
    with_product = _counted(join_items(sold, products), seen.with_product)
    sold = _counted(
        with_product.join(
            categories, F.col("product_category_id") == F.col("category_id"), "inner"
        ),
        seen.with_category,
    )
    product = ["product_id", "category_id", "category_name", "category_department_id"]
    rows = sold.select(
        *product,
        F.col("order_customer_id").alias("customer_id"),
        "order_item_quantity",
        "order_item_subtotal",
    )
    columns = [F.col(c) for c in (*product, "customer_id")]
    return rows.groupingSets([columns[:-1], columns[-1:]], *columns).agg(
        F.when(F.grouping("customer_id") == 1, "product").otherwise("customer").alias("per"),
        F.sum("order_item_quantity").alias("order_item_quantity"),
        F.sum("order_item_subtotal").alias("order_item_subtotal"),
    )


def per_product(totals: DataFrame) -> DataFrame:
    """What the product, category and department reports read of ``day_totals``."""
    return totals.where("per = 'product'").drop("per", "customer_id")


def per_customer(totals: DataFrame) -> DataFrame:
    """What the customer report reads of ``day_totals``."""
    return totals.where("per = 'customer'").select(
        "customer_id", "order_item_quantity", "order_item_subtotal"
    )


def customer_sales_fact(
    orders: DataFrame, items: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    """The fact summed to one row per order, for reports by customer over long periods.

    Holds ``customer_id`` and ``order_item_subtotal`` only. The orders of the period
    come first: where they can be broadcast they thin the items out before any
    shuffle, whatever their ids are; otherwise items and orders meet by order id,
    and the sums follow in the same partitions.
    """
    sold = join_items(join_orders(items, orders), products).join(
        categories, F.col("product_category_id") == F.col("category_id"), "inner"
    )
    return (
        sold.groupBy("order_item_order_id", F.col("order_customer_id").alias("customer_id"))
        .agg(F.sum("order_item_subtotal").alias("order_item_subtotal"))
        .select("customer_id", "order_item_subtotal")
    )


def customer_day_sums(
    orders: DataFrame, items: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    """The fact summed to one row per day and customer: customer_id, order_item_subtotal, dt."""
    sold = join_items(join_orders(items, orders), products).join(
        categories, F.col("product_category_id") == F.col("category_id"), "inner"
    )
    return (
        sold.groupBy("dt", F.col("order_customer_id").alias("customer_id"))
        .agg(F.sum("order_item_subtotal").alias("order_item_subtotal"))
        .select("customer_id", "order_item_subtotal", "dt")
    )


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame in executor memory, spilling to disk, while several reports read it.

    Select the needed columns first: a cached frame keeps every column it has.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
