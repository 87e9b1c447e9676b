"""Group sums and counts, top lists and name lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A frame proven to hold at most this many rows may carry a broadcast hint.
HINTED_BROADCAST_ROWS = 10_000


def sum_by(
    df: DataFrame, keys: list[str | Column], measure: str, name: str, scale: int | None = None
) -> DataFrame:
    """Sum ``measure`` per group; rounded half up once, after summing, if ``scale`` is set."""
    total = F.sum(measure)
    return df.groupBy(*keys).agg((total if scale is None else F.round(total, scale)).alias(name))


def count_by(df: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """Count the non-null values of ``column`` per group."""
    return df.groupBy(*keys).agg(F.count(column).alias(name))


def new_watermark(batch: DataFrame, column: str) -> DataFrame:
    """Largest value of the check column; NULL for an empty batch."""
    return batch.agg(F.max(column).alias("last_value"))


def top_k(df: DataFrame, key: str, measure: str, k: int) -> DataFrame:
    """The ``k`` rows with the largest ``measure``; equal values go to the lower key.

    Each partition keeps its own best ``k`` rows, so only those are merged.
    """
    return df.orderBy(F.desc(measure), F.asc(key)).limit(k)


def enrich(
    df: DataFrame, dimension: DataFrame, key: str, max_rows: int | None = None
) -> DataFrame:
    """Inner join with a dimension on a column of the same name.

    ``max_rows`` is a proven row bound of ``df``, such as the ``k`` of a top
    list; only such a frame is broadcast by hint, so that a large dimension is
    scanned in place instead of shuffled.
    """
    small = max_rows is not None and max_rows <= HINTED_BROADCAST_ROWS
    return dimension.join(F.broadcast(df) if small else df, key, "inner")
