"""Append-only tables: batches, order-id bands, commits and compaction.

Every append is a batch with a number of its own and lies in directories
``import_batch=<number>/order_band=<order id div width>``. One row per table says
which batches count; a reader asks for batches up to the last one, so an append
that stopped half-way is invisible and the next one removes it. A range of order
ids names its bands, so readers prune directories and not file footers.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.schemas import BAND, BATCH
from daybook.sinks.tables import (
    add_missing_columns,
    drop_partitions,
    ensure_partitioned_table,
    insert_partitions,
    partition_values,
    qualified,
    remove_folder,
    table_location,
    table_property,
)

STATE_TABLE = "import_commits"
# Order ids of one band. A table keeps the width it was created with.
ORDER_BAND = 10_000_000
_WIDTH = "daybook.order_band_width"
# A band with more batches than this is rewritten, into files of about so many rows.
MOST_BATCHES, ROWS_PER_FILE = 16, 4_000_000


@dataclass(frozen=True)
class Commit:
    """What counts of a table.

    Rows up to ``last_value`` of the check column have been imported, and batches up to
    ``last_batch`` count. ``open_batch`` is one being written. In a compacted band,
    batches before ``compacted_batch`` count no more, whether or not they are gone.
    """

    last_value: int = 0
    last_batch: int = 0
    open_batch: int | None = None
    compacted_band: int | None = None
    compacted_batch: int | None = None


_STATE = T.StructType([T.StructField(name, T.LongType()) for name in asdict(Commit())])


def last_commit(spark: SparkSession, database: str, table: str) -> Commit:
    state = qualified(database, STATE_TABLE)
    ensure_partitioned_table(spark, state, _STATE, "table_name")
    row = spark.table(state).where(F.col("table_name") == table).first()
    return Commit() if row is None else Commit(*[row[name] for name in _STATE.names])


def commit(spark: SparkSession, database: str, table: str, what: Commit) -> None:
    """Replace the table's row; the files of the row before stay until then."""
    state = qualified(database, STATE_TABLE)
    ensure_partitioned_table(spark, state, _STATE, "table_name")
    values = [F.lit(v).cast("bigint").alias(k) for k, v in asdict(what).items()]
    row = spark.range(0, 1, 1, 1).select(*values, F.lit(table).alias("table_name"))
    insert_partitions(row, state, [*_STATE.names, "table_name"])


def band_width(spark: SparkSession, database: str, table: str) -> int | None:
    """Order ids in a band of this table; None if it has no bands."""
    found = table_property(spark, qualified(database, table), _WIDTH)
    return None if found is None else int(found)


def committed_rows(spark: SparkSession, database: str, table: str = "order_items") -> DataFrame:
    """All rows that count, with the directory columns a range filter can use."""
    rows = spark.table(qualified(database, table))
    if BATCH not in rows.columns:
        return rows
    return _counting(rows, last_commit(spark, database, table))


def _counting(rows: DataFrame, state: Commit) -> DataFrame:
    rows = rows.where(F.col(BATCH) <= state.last_batch)
    if state.compacted_batch is None:
        return rows
    elsewhere = ~F.col(BAND).eqNullSafe(F.lit(state.compacted_band).cast("bigint"))
    return rows.where(elsewhere | (F.col(BATCH) >= state.compacted_batch))


def imported(spark: SparkSession, database: str, table: str = "order_items") -> DataFrame:
    """All rows that count, in the columns of the source."""
    return committed_rows(spark, database, table).drop(BATCH, BAND)


def clean_up(spark: SparkSession, database: str, table: str) -> Commit:
    """Remove what a stopped append or compaction left; returns the state after that."""
    state, target = last_commit(spark, database, table), qualified(database, table)
    if state.last_batch == 0:
        _remove_batches(spark, target, None)  # nothing counts: a reset, or no first import yet
    if state.open_batch is not None:
        _remove_batches(spark, target, state.open_batch)
        state = replace(state, open_batch=None)
        commit(spark, database, table, state)
    if state.compacted_batch is not None:
        _retire(spark, target, state.compacted_band, state.compacted_batch)
        state = replace(state, compacted_band=None, compacted_batch=None)
        commit(spark, database, table, state)
    return state


def _remove_batches(spark: SparkSession, target: str, batch: int | None) -> None:
    """Drop one batch, or all, that does not count, with files the catalog may not know of."""
    if not spark.catalog.tableExists(target) or BATCH not in spark.table(target).columns:
        return
    gone = [p for p in partition_values(spark, target) if batch is None or p[BATCH] == str(batch)]
    drop_partitions(spark, target, gone)
    if batch is not None:
        remove_folder(spark, f"{table_location(spark, target)}/{BATCH}={batch}")


def _retire(spark: SparkSession, target: str, band: int | None, before: int) -> None:
    """Drop the batches of a band that a compaction has replaced."""
    name = None if band is None else str(band)
    old = [
        p for p in partition_values(spark, target) if p[BAND] == name and int(p[BATCH]) < before
    ]
    drop_partitions(spark, target, old)


def begin(spark: SparkSession, database: str, table: str) -> tuple[Commit, int]:
    """Note a new batch number before anything is written under it.

    Numbers grow and are never used twice, so files of a stopped append cannot come
    to lie beside those of a later one.
    """
    state = clean_up(spark, database, table)
    number = max(state.last_batch + 1, time.time_ns())
    state = replace(state, open_batch=number)
    commit(spark, database, table, state)
    return state, number


def write_batch(
    rows: DataFrame, database: str, table: str, batch: int, cluster_by: str | None, width: int
) -> None:
    """Write rows as one batch; columns that the table lacks are added to it first.

    Rows are sorted by band and ``cluster_by`` inside each task, without a shuffle.
    """
    spark, target = rows.sparkSession, qualified(database, table)
    if not spark.catalog.tableExists(target):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        bands = "" if cluster_by is None else f", {BAND} BIGINT"
        names = BATCH if cluster_by is None else f"{BATCH}, {BAND}"
        told = "" if cluster_by is None else f" TBLPROPERTIES ('{_WIDTH}' = '{width}')"
        spark.sql(
            f"CREATE TABLE {target} ({fields}, {BATCH} BIGINT{bands}) "
            f"USING parquet PARTITIONED BY ({names}){told}"
        )
    known = spark.table(target).columns
    if BATCH not in known:
        raise ValueError(f"{target} has no batches; import it into a new table")
    banded = BAND in known
    rows = add_missing_columns(rows, target, but=(BATCH, BAND))
    if banded:
        width = band_width(spark, database, table)
        rows = rows.withColumn(BAND, F.expr(f"`{cluster_by}` div {width}"))
        rows = rows.sortWithinPartitions(BAND, cluster_by)
    _insert(rows, target, batch, banded)


def _insert(rows: DataFrame, target: str, batch: int, banded: bool) -> None:
    """Add rows to a batch: its directory is fixed, those of the bands come from the rows."""
    spark, view = rows.sparkSession, f"batch_{uuid.uuid4().hex}"
    columns = [c for c in spark.table(target).columns if c != BATCH]
    rows.select(columns).createTempView(view)
    try:
        spark.sql(
            f"INSERT INTO {target} PARTITION ({BATCH} = {batch}{', ' + BAND if banded else ''}) "
            f"SELECT * FROM {view}"
        )
    finally:
        spark.catalog.dropTempView(view)


def compact(
    spark: SparkSession,
    database: str,
    table: str = "order_items",
    cluster_by: str = "order_item_order_id",
    check_column: str = "order_item_id",
    most_batches: int = MOST_BATCHES,
    rows_per_file: int = ROWS_PER_FILE,
) -> int:
    """Rewrite the bands that are spread over many batches; returns how many.

    The rows of a band become one batch of files sorted by ``cluster_by``, cut at
    (cluster_by, check_column), so that one order with very many items is cut as well.
    One commit switches readers over; the replaced batches go after that.
    """
    target = qualified(database, table)
    if not spark.catalog.tableExists(target) or BAND not in spark.table(target).columns:
        return 0
    state = clean_up(spark, database, table)
    batches: dict[str | None, int] = {}
    for p in partition_values(spark, target):
        if int(p[BATCH]) <= state.last_batch:
            batches[p[BAND]] = batches.get(p[BAND], 0) + 1
    crowded = [None if b is None else int(b) for b, n in batches.items() if n > most_batches]
    for band in crowded:
        state, number = begin(spark, database, table)
        same = F.col(BAND).eqNullSafe(F.lit(band).cast("bigint"))
        rows = _counting(spark.table(target), state).where(same).drop(BATCH)
        files = max(1, -(-rows.count() // rows_per_file))
        ranged = rows.repartitionByRange(files, cluster_by, check_column)
        _insert(ranged.sortWithinPartitions(BAND, cluster_by), target, number, True)
        state = replace(
            state, last_batch=number, open_batch=None, compacted_band=band, compacted_batch=number
        )
        commit(spark, database, table, state)
        clean_up(spark, database, table)
    return len(crowded)
