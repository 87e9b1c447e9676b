"""Scans of the warehouse tables, with the filters of the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.context import RunContext
from daybook.functions.periods import in_month, on_day
from daybook.schemas import BAND, EXCLUDED_STATUSES, band_of


def exclude_status(status: Column, statuses: tuple[str, ...] = EXCLUDED_STATUSES) -> Column:
    """``NOT IN``: a NULL status is neither in nor out, so the row is dropped."""
    return ~status.isin(*statuses)


def newer_than(check_column: str, last_value: int) -> Column:
    """Rows beyond a saved high-water mark."""
    return F.col(check_column) > F.lit(last_value)


def orders_for_day(orders: DataFrame, day: str, all_statuses: bool = False) -> DataFrame:
    """One day of orders; without cancelled and held ones unless ``all_statuses``."""
    rows = orders.where(on_day(F.col("dt"), day))
    return rows if all_statuses else rows.where(exclude_status(F.col("order_status")))


def orders_for_month(orders: DataFrame, ctx: RunContext) -> DataFrame:
    """Sales orders of the calendar month before the run date."""
    return orders.where(in_month(F.col("dt"), ctx) & exclude_status(F.col("order_status")))


def select_orders_layout(orders: DataFrame) -> DataFrame:
    """Columns of the warehouse table in its order, partition column last."""
    return orders.select("order_id", "order_date", "order_customer_id", "order_status", "dt")


def items_in_order_range(
    items: DataFrame, orders: DataFrame, band_width: int | None = None
) -> DataFrame:
    """Items whose order id lies between the smallest and largest id of ``orders``.

    Every item that joins ``orders`` passes. Order ids grow with time, and items are
    stored in directories by bands of ``band_width`` order ids and sorted by order id
    within each load: the literal range prunes the directories of other bands, and lets
    Parquet skip nearly all row groups of other periods in those left. Only the two
    bounds reach the driver.
    """
    return in_order_range(items, *order_bounds(orders), band_width)


def order_bounds(orders: DataFrame) -> tuple[int | None, int | None]:
    """Smallest and largest order id; None without orders."""
    return tuple(orders.agg(F.min("order_id"), F.max("order_id")).first())


def in_order_range(
    items: DataFrame, low: int | None, high: int | None, band_width: int | None
) -> DataFrame:
    """Items of the orders from ``low`` to ``high``, read from the bands they lie in."""
    if low is None:
        return items.where(F.lit(False))
    rows = items.where(F.col("order_item_order_id").between(low, high))
    if band_width is None or BAND not in items.columns:
        return rows
    return rows.where(F.col(BAND).between(band_of(low, band_width), band_of(high, band_width)))
