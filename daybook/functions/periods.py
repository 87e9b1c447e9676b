"""Period columns: day and month labels as strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.context import RunContext

# Label formats of the period columns.
DAY_FORMAT = "yyyy-MM-dd"
MONTH_FORMAT = "yyyy-MM"

SECONDS_PER_DAY = 86400


def with_period(df: DataFrame, name: str, value: str) -> DataFrame:
    """Append a constant period column, e.g. ``txn_date`` or ``txn_month``."""
    return df.withColumn(name, F.lit(value))


def with_partition_day(df: DataFrame, day: str) -> DataFrame:
    """All columns of ``df`` plus the partition column ``dt``."""
    return df.select("*", F.lit(day).alias("dt"))


def day_label(day: Column) -> Column:
    return F.date_format(day, DAY_FORMAT)


def month_label(day: Column) -> Column:
    return F.date_format(day, MONTH_FORMAT)


def month_prefix(day_string: Column) -> Column:
    """``yyyy-MM`` part of a ``yyyy-MM-dd`` string."""
    return F.substring(day_string, 1, 7)


def epoch_seconds(day: Column) -> Column:
    """Seconds from 1970-01-01 to the start of ``day``, in calendar days."""
    return F.unix_date(day).cast("bigint") * SECONDS_PER_DAY


def day_from_epoch(seconds: Column, days_back: int) -> Column:
    """Calendar day ``days_back`` days before the day ``seconds`` falls on.

    Steps whole calendar days instead of 86400-second blocks, so days with a
    clock change give the same answer as any other day.
    """
    day = F.date_from_unix_date(F.floor(seconds / SECONDS_PER_DAY).cast("int"))
    return F.date_sub(day, days_back)


def on_day(dt: Column, day: str) -> Column:
    """Partition filter for one day; string to string, so it prunes without a cast."""
    return dt == F.lit(day)


def in_month(dt: Column, ctx: RunContext) -> Column:
    """Partition filter for the reported month, as a range the catalog can prune."""
    return (dt >= F.lit(ctx.month_start.isoformat())) & (
        dt < F.lit(ctx.month_end_excl.isoformat())
    )
