"""Move historic order dates into the present, and check the result."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Days before the anchor where the moved window starts and ends,
# and how far it is moved.
WINDOW_START = 3279
WINDOW_END = 2915
OFFSET_DAYS = 2979


def _window(anchor: date) -> tuple[date, date]:
    return anchor - timedelta(days=WINDOW_START), anchor - timedelta(days=WINDOW_END)


def rebase_order_dates(df: DataFrame, anchor: date, column: str = "order_date") -> DataFrame:
    """Shift the dates inside the window before ``anchor`` by a fixed number of days.

    One projection over all rows. Values that are not exactly a day (a time of
    day, another text format) and dates outside the window stay as they are.
    """
    kind = df.schema[column].dataType.simpleString()
    value = F.col(column)
    day = value.try_cast("date")
    first, last = _window(anchor)
    moves = (day.cast(kind) == value) & day.between(F.lit(first), F.lit(last))
    moved = F.date_add(day, OFFSET_DAYS).cast(kind)
    return df.withColumn(column, F.when(moves, moved).otherwise(value))


def source_days(day: date, anchor: date) -> list[date]:
    """Days in the unmoved source that are ``day`` after the rebase.

    Lets a filter on a moved date still be pushed to the source.
    """
    first, last = _window(anchor)
    candidates = (day, day - timedelta(days=OFFSET_DAYS))
    return [
        d
        for d in candidates
        if (d + timedelta(days=OFFSET_DAYS) if first <= d <= last else d) == day
    ]


def max_order_date(df: DataFrame, column: str = "order_date") -> DataFrame:
    return df.agg(F.max(column).alias("max_order_date"))
