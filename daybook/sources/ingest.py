"""Import from the source into the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.casts import cast_known, cast_to_sink
from daybook.functions.periods import with_partition_day
from daybook.operators.metrics import new_watermark
from daybook.operators.scans import select_orders_layout
from daybook.schemas import MODEL, SNAPSHOT_KEYS
from daybook.sinks.kept import forget_days
from daybook.sinks.tables import (
    ensure_orders_table,
    insert_partitions,
    publish_version,
    qualified,
    truncate,
)
from daybook.sources import appended
from daybook.sources.readers import Reader, SourceFilter, Split


class TableExistsError(ValueError):
    """A snapshot in mode ``create`` found its table; mode ``overwrite`` replaces it."""


def snapshot_import(
    spark: SparkSession,
    reader: Reader,
    database: str,
    table: str,
    mode: str = "overwrite",
    tasks: int = 2,
) -> None:
    """Copy a whole source table; importing twice gives the same table as importing once.

    Every import writes a version folder of its own and then points the table's name
    at it, so a source or a write that fails half-way leaves the last snapshot in
    place, and nothing is copied twice. Readers that are still at work find the
    version before; older ones are removed.
    """
    target = qualified(database, table)
    if mode == "create" and spark.catalog.tableExists(target):
        raise TableExistsError(f"{target} exists already")
    rows = reader.read(table, split=Split(SNAPSHOT_KEYS[table], tasks))
    publish_version(rows, database, table)


def read_orders_day(reader: Reader, day: str, tasks: int = 2) -> DataFrame:
    """One day of source orders with the partition column; the source applies the filter.

    A source that stores a time of day is matched on exact equality with the
    date, so only orders stamped midnight are read.
    """
    rows = reader.read("orders", SourceFilter.equals("order_date", day), Split("order_id", tasks))
    return with_partition_day(rows, day)


def import_orders_day(
    spark: SparkSession, reader: Reader, database: str, day: str, tasks: int = 2
) -> None:
    """Load one day of orders; a day without rows keeps what was loaded before."""
    load_orders_partitions(spark, read_orders_day(reader, day, tasks), database, days=[day])


def load_orders_partitions(
    spark: SparkSession,
    staged: DataFrame,
    database: str,
    backfill_tasks: int | None = None,
    days: list[str] | None = None,
) -> None:
    """Replace the ``dt`` partitions that occur in ``staged``, and no others.

    Sums that were kept of ``days`` count no more; where it is not said which days
    occur, none do.

    One day needs no redistribution. A back-fill of many days is first split into
    ``backfill_tasks`` equal ranges of (day, order id): a task then writes few
    days, and a day with very many rows is shared by several tasks.
    """
    table = ensure_orders_table(spark, database)
    forget_days(spark, database, days)
    rows = cast_to_sink(select_orders_layout(staged), MODEL["orders"])
    if backfill_tasks is not None:
        rows = rows.repartitionByRange(backfill_tasks, "dt", "order_id")
    insert_partitions(rows, table, spark.table(table).columns)


def saved_watermark(spark: SparkSession, database: str, table: str) -> int:
    """Last imported value of a table's check column; 0 before the first import."""
    return appended.last_commit(spark, database, table).last_value


def save_watermark(spark: SparkSession, database: str, table: str, last_value: int) -> None:
    """Set the mark and declare that no batch of the table counts."""
    appended.commit(spark, database, table, appended.Commit(last_value))


def incremental_append(
    spark: SparkSession,
    reader: Reader,
    database: str,
    table: str = "order_items",
    check_column: str = "order_item_id",
    cluster_by: str | None = "order_item_order_id",
    tasks: int | None = None,
    band_width: int = appended.ORDER_BAND,
) -> int:
    """Append the rows beyond the saved high-water mark and save the new one.

    The rows become a batch of their own, and one commit writes the mark and makes the
    batch count. If a run stops before that, nothing of it is seen, and the next run
    removes what had landed and reads from the old mark again; the check column need
    not be unique for that.

    Every column of the source is kept, also those the reports do not use; one
    that the source gained later is added to the target. Rows lie in directories by
    bands of ``cluster_by`` and are sorted by it inside each task, without a shuffle.
    Read the rows through ``appended.imported``. Returns the mark.
    """
    state, batch = appended.begin(spark, database, table)
    last = state.last_value
    split = Split(check_column, tasks) if tasks else None
    rows = reader.read(table, SourceFilter.greater(check_column, last), split)
    rows = cast_known(rows, MODEL[table]) if table in MODEL else rows
    appended.write_batch(rows, database, table, batch, cluster_by, band_width)

    written = spark.table(qualified(database, table)).where(F.col(appended.BATCH) == batch)
    mark = new_watermark(written, check_column).first()["last_value"]
    mark = last if mark is None else mark
    appended.commit(spark, database, table, appended.Commit(mark, batch))
    return mark


def reset_incremental(spark: SparkSession, database: str, table: str = "order_items") -> None:
    """Empty the target and forget its high-water mark, so the next run loads everything.

    The mark goes first, and with it every batch stops counting: a stop in between
    leaves rows that nobody sees. The rows themselves go by their directories.
    """
    save_watermark(spark, database, table, 0)
    forget_days(spark, database)
    truncate(spark, qualified(database, table))
