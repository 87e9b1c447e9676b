"""The sales model on top of the sample order tables used for checks.

Columns are mapped by plain expressions, so column pruning and the date filter
reach the Parquet files.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.context import RunContext
from daybook.sources.readers import FrameReader


# The columns in use. Naming them saves a job per table that would
# only look the schema up in the files.
COLUMNS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE"
    ),
}

# The order states the sample's status and priority stand for.
STATUS = """CASE
    WHEN o_orderstatus = 'F' THEN 'COMPLETE'
    WHEN o_orderstatus = 'O' THEN 'PENDING'
    WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'CANCELED'
    WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'ON_HOLD'
    ELSE 'PROCESSING' END"""


@dataclass(frozen=True)
class SampleTables:
    spark: SparkSession
    root: str

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(COLUMNS[name]).parquet(f"{self.root}/{name}.parquet")

    def departments(self) -> DataFrame:
        return self._table("region").selectExpr(
            "r_regionkey AS department_id", "r_name AS department_name"
        )

    def categories(self) -> DataFrame:
        return self._table("nation").selectExpr(
            "n_nationkey AS category_id",
            "n_regionkey AS category_department_id",
            "n_name AS category_name",
        )

    def products(self) -> DataFrame:
        """Brand numbers 1 to 25 become category ids 0 to 24."""
        return self._table("part").selectExpr(
            "p_partkey AS product_id",
            "CAST(substr(p_brand, 7) AS INT) - 1 AS product_category_id",
            "p_name AS product_name",
        )

    def customers(self) -> DataFrame:
        nation, region = self._table("nation"), self._table("region")
        return (
            self._table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr(
                "c_custkey AS customer_id",
                "substr(c_name, 1, 8) AS customer_fname",
                "substr(c_name, 10) AS customer_lname",
                "n_name AS customer_city",
                "r_name AS customer_state",
            )
        )

    def orders(self, first: date | None = None, end: date | None = None) -> DataFrame:
        """Orders, optionally only those with ``first <= date < end``, filtered in the scan."""
        rows = self._table("orders")
        if first is not None:
            rows = rows.where(f"o_orderdate >= TIMESTAMP_NTZ '{first}'")
        if end is not None:
            rows = rows.where(f"o_orderdate < TIMESTAMP_NTZ '{end}'")
        return rows.selectExpr(
            "o_orderkey AS order_id",
            "CAST(CAST(o_orderdate AS DATE) AS STRING) AS order_date",
            "o_custkey AS order_customer_id",
            f"{STATUS} AS order_status",
            "CAST(CAST(o_orderdate AS DATE) AS STRING) AS dt",
        )

    def orders_on(self, ctx: RunContext) -> DataFrame:
        return self.orders(ctx.txn_day, ctx.txn_day + timedelta(days=1))

    def source_orders(self, first: date | None = None, end: date | None = None) -> DataFrame:
        """Orders as a source database has them: without the partition column."""
        return self.orders(first, end).drop("dt")

    def order_items(self) -> DataFrame:
        return self._table("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber AS order_item_id",
            "l_orderkey AS order_item_order_id",
            "l_partkey AS order_item_product_id",
            "CAST(l_quantity AS INT) AS order_item_quantity",
            "l_extendedprice AS order_item_subtotal",
        )

    def reader(self) -> FrameReader:
        """All six tables as an import source."""
        return FrameReader(
            {
                "categories": self.categories(),
                "departments": self.departments(),
                "products": self.products(),
                "customers": self.customers(),
                "orders": self.source_orders(),
                "order_items": self.order_items(),
            }
        )
