"""Daily sums that are kept for later reports, and the ledger of the days that count.

A day's row in the ledger is written last and removed first, so sums without a row
are leftovers that nobody reads.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.sinks.tables import (
    drop_partitions,
    ensure_partitioned_table,
    insert_partitions,
    qualified,
    replace_period,
)

LEDGER, CUSTOMER_SUMS, PRODUCT_SUMS = "kept_days", "customer_day_sums", "product_day_sums"
_LONG, _DOUBLE, _STRING = T.LongType(), T.DoubleType(), T.StringType()
_COLUMNS = {
    CUSTOMER_SUMS: T.StructType(
        [T.StructField("customer_id", _LONG), T.StructField("order_item_subtotal", _DOUBLE)]
    ),
    PRODUCT_SUMS: T.StructType(
        [
            T.StructField("product_id", _LONG),
            T.StructField("order_item_quantity", _LONG),
            T.StructField("order_item_subtotal", _DOUBLE),
        ]
    ),
    LEDGER: T.StructType(
        [
            T.StructField("items_mark", _LONG),
            T.StructField("low", _LONG),
            T.StructField("high", _LONG),
            T.StructField("catalog", _STRING),
            T.StructField("sold", _LONG),
            T.StructField("with_product", _LONG),
            T.StructField("with_category", _LONG),
        ]
    ),
}


@dataclass(frozen=True)
class KeptDay:
    """What a day's sums were made from.

    ``items_mark`` is the last item imported by then, ``low`` and ``high`` bound the
    order ids of the day's sales, ``catalog`` is a fingerprint of the products with a
    category. ``sold`` counts the items of those orders, ``with_product`` and
    ``with_category`` the rows that the lookups left; None where they were not counted.
    """

    dt: str
    items_mark: int
    low: int | None
    high: int | None
    catalog: str | None = None
    sold: int | None = None
    with_product: int | None = None
    with_category: int | None = None

    @property
    def complete(self) -> bool:
        """Whether no item of the day was left out for want of a product or category."""
        return self.sold is not None and self.sold == self.with_product == self.with_category


def kept_table(spark: SparkSession, database: str, name: str) -> str:
    table = qualified(database, name)
    ensure_partitioned_table(spark, table, _COLUMNS[name], "dt")
    return table


def kept_days(spark: SparkSession, database: str, first: str, end: str) -> dict[str, KeptDay]:
    """The ledger of the days from ``first`` to before ``end``."""
    rows = spark.table(kept_table(spark, database, LEDGER))
    names = [f.name for f in fields(KeptDay)]
    found = rows.where(F.col("dt").between(first, end) & (F.col("dt") < end)).select(names).collect()
    return {row["dt"]: KeptDay(*row) for row in found}


def write_ledger(spark: SparkSession, database: str, days: list[KeptDay]) -> None:
    """Declare that the sums of these days count."""
    table = kept_table(spark, database, LEDGER)
    columns = [f.name for f in fields(KeptDay)]
    schema = T.StructType([T.StructField("dt", _STRING), *_COLUMNS[LEDGER].fields])
    values = [tuple(getattr(day, name) for name in columns) for day in days]
    rows = spark.createDataFrame(values, schema).coalesce(1)
    insert_partitions(rows, table, [*_COLUMNS[LEDGER].names, "dt"])


def keep_sums(df: DataFrame, database: str, name: str, day: str) -> None:
    """Replace one day of a table of sums."""
    table = kept_table(df.sparkSession, database, name)
    replace_period(df.select(_COLUMNS[name].names), table, "dt", day)


def keep_days(df: DataFrame, database: str, name: str, days: list[str]) -> None:
    """Replace several days of a table of sums; days without rows become empty."""
    table = kept_table(df.sparkSession, database, name)
    drop_partitions(df.sparkSession, table, [{"dt": day} for day in days])
    insert_partitions(df, table, [*_COLUMNS[name].names, "dt"])


def forget_days(spark: SparkSession, database: str, days: list[str] | None = None) -> None:
    """Declare that kept sums count no more: those of ``days``, or all."""
    table = qualified(database, LEDGER)
    if not spark.catalog.tableExists(table):
        return
    if days is None:
        spark.sql(f"TRUNCATE TABLE {table}")
    else:
        drop_partitions(spark, table, [{"dt": day} for day in days])
