"""Schemas of the warehouse tables and of the report tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LONG, INT, DOUBLE, STRING = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# Table names, column names and types are the contract with the
# source database and with the readers of the reports.
MODEL = {
    "categories": _struct(
        ("category_id", INT), ("category_department_id", INT), ("category_name", STRING)
    ),
    "departments": _struct(("department_id", INT), ("department_name", STRING)),
    "products": _struct(
        ("product_id", LONG), ("product_category_id", INT), ("product_name", STRING)
    ),
    "customers": _struct(
        ("customer_id", LONG),
        ("customer_fname", STRING),
        ("customer_lname", STRING),
        ("customer_city", STRING),
        ("customer_state", STRING),
    ),
    "orders": _struct(
        ("order_id", LONG),
        ("order_date", STRING),
        ("order_customer_id", LONG),
        ("order_status", STRING),
        ("dt", STRING),
    ),
    "order_items": _struct(
        ("order_item_id", LONG),
        ("order_item_order_id", LONG),
        ("order_item_product_id", LONG),
        ("order_item_quantity", INT),
        ("order_item_subtotal", DOUBLE),
    ),
}

# Directory columns of an append-only table: the append, and the band of order ids.
BATCH, BAND = "import_batch", "order_band"


def band_of(order_id: int, width: int) -> int:
    """The band of an order id; as SQL's ``div``: towards zero, also below it."""
    return order_id // width if order_id >= 0 else -(-order_id // width)


# Tables replaced as a whole at every import, with the key the
# parallel source read is split on.
SNAPSHOT_KEYS = {
    "categories": "category_id",
    "departments": "department_id",
    "products": "product_id",
    "customers": "customer_id",
}

# Orders in these states are not sales.
EXCLUDED_STATUSES = ("CANCELED", "ON_HOLD")


@dataclass(frozen=True)
class ReportTable:
    """Layout of one report table; the period column is always last."""

    name: str
    columns: T.StructType
    period_column: str = "txn_date"

    @property
    def column_names(self) -> list[str]:
        return [*self.columns.names, self.period_column]


_TOP_CUSTOMER = (
    ("customer_id", INT),
    ("customer_fname", STRING),
    ("customer_lname", STRING),
    ("customer_city", STRING),
    ("customer_state", STRING),
    ("total_amount", DOUBLE),
)

# Report tables by report key.
REPORT_TABLES = {
    "category_sales": ReportTable(
        "category_wise_sales",
        _struct(
            ("category_id", INT),
            ("category_name", STRING),
            ("department_name", STRING),
            ("total_sales", DOUBLE),
        ),
    ),
    "department_sales": ReportTable(
        "department_wise_sales",
        _struct(("department_id", INT), ("department_name", STRING), ("total_sales", DOUBLE)),
    ),
    "top_products_qty": ReportTable(
        "top5_prod_qty",
        _struct(("product_id", INT), ("product_name", STRING), ("total_qty", DOUBLE)),
    ),
    "top_products_amount": ReportTable(
        "top5_prod_amt",
        _struct(("product_id", INT), ("product_name", STRING), ("total_amount", DOUBLE)),
    ),
    "order_status": ReportTable(
        "order_status", _struct(("order_status", STRING), ("order_count", LONG))
    ),
    "top_customers_day": ReportTable("top5_custs_daily", _struct(*_TOP_CUSTOMER)),
    "top_customers_month": ReportTable(
        "top5_custs_monthly", _struct(*_TOP_CUSTOMER), "txn_month"
    ),
}
