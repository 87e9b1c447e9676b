"""The append-only item table: bands, batches, commits, compaction."""

import pytest
from pyspark.sql import functions as F
from shop import frames

from daybook.operators.scans import items_in_order_range
from daybook.schemas import BAND, BATCH, MODEL, band_of
from daybook.sinks import tables
from daybook.sources import appended, ingest
from daybook.sources.readers import FrameReader


def source(spark, items):
    """Items given as (item id, order id)."""
    data = [(i, order, 100, 1, float(i)) for i, order in items]
    return FrameReader({"order_items": spark.createDataFrame(data, MODEL["order_items"])})


def append(spark, database, items, **options):
    return ingest.incremental_append(spark, source(spark, items), database, band_width=10, **options)


def found(spark, database):
    return values(appended.imported(spark, database), "order_item_id", "order_item_order_id")


def values(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def plan(df):
    return df._jdf.queryExecution().toString()


def directories(spark, database):
    values = tables.partition_values(spark, f"{database}.order_items")
    return [(int(v[BATCH]), v[BAND]) for v in values]


def test_a_range_of_orders_reads_its_bands_only(spark, database):
    items = [(i, i // 3) for i in range(1, 300)]
    append(spark, database, items)
    assert {band for _, band in directories(spark, database)} == {str(b) for b in range(10)}
    orders = spark.createDataFrame([(41,), (47,)], "order_id long")
    width = appended.band_width(spark, database, "order_items")
    assert width == 10
    day = items_in_order_range(appended.committed_rows(spark, database), orders, width)
    text = plan(day)
    assert f"({BAND}#" in text.split("PartitionFilters: [")[1].split("]")[0]
    files = {r[0] for r in day.select(F.input_file_name()).distinct().collect()}
    assert files and all(f"{BAND}=4/" in f for f in files)
    assert values(day, "order_item_id") == [(i,) for i, o in items if 41 <= o <= 47]


def test_bands_below_zero(spark, database):
    orders = [-25, -10, -9, -1, 0, 9, 10]
    append(spark, database, list(enumerate(orders, start=1)))
    stored = spark.table(f"{database}.order_items").select("order_item_order_id", BAND).collect()
    assert {r[0]: r[1] for r in stored} == {o: band_of(o, 10) for o in orders}
    bounds = spark.createDataFrame([(-12,), (-1,)], "order_id long")
    some = items_in_order_range(appended.committed_rows(spark, database), bounds, 10)
    assert values(some, "order_item_order_id") == [(-10,), (-9,), (-1,)]


def test_the_next_append_finds_only_new_directories(spark, database):
    """The mark of a batch is read from its own directory, however large the table is."""
    append(spark, database, [(i, i) for i in range(1, 50)])
    state = appended.last_commit(spark, database, "order_items")
    written = spark.table(f"{database}.order_items").where(F.col(BATCH) == state.last_batch)
    assert f"{BATCH}#" in plan(written).split("PartitionFilters: [")[1].split("]")[0]


def test_repeated_item_ids_survive_a_stop(spark, database, monkeypatch):
    """Recovery goes by batch: rows that share an id are neither lost nor doubled."""
    items = [(1, 5), (1, 5), (2, 17), (2, 33), (3, 17)]
    append(spark, database, items[:2])
    commit = appended.commit

    def stopped(spark, database, table, what):
        if what.open_batch is None:
            raise RuntimeError("stopped before the commit")
        commit(spark, database, table, what)

    monkeypatch.setattr(appended, "commit", stopped)
    with pytest.raises(RuntimeError):
        append(spark, database, items)
    assert spark.table(f"{database}.order_items").count() == 5  # landed
    assert found(spark, database) == items[:2]  # but not seen
    assert ingest.saved_watermark(spark, database, "order_items") == 1
    monkeypatch.setattr(appended, "commit", commit)
    assert append(spark, database, items) == 3
    assert found(spark, database) == sorted(items)
    assert spark.table(f"{database}.order_items").count() == 5


def test_files_the_catalog_does_not_know_are_removed(spark, database):
    append(spark, database, [(1, 5)])
    state, batch = appended.begin(spark, database, "order_items")
    place = tables.table_location(spark, f"{database}.order_items")
    spark.range(3).write.parquet(f"{place}/{BATCH}={batch}/{BAND}=0")
    assert append(spark, database, [(1, 5), (2, 6)]) == 2
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/{BATCH}={batch}")
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    assert found(spark, database) == [(1, 5), (2, 6)]


def test_compaction_bounds_the_files_and_keeps_the_rows(spark, database):
    """A dozen appends to two bands, compacted as the daily job does it."""
    everything, most = [], 3
    for day in range(12):
        everything += [(10 * day + k, day + (k % 2) * 10) for k in range(1, 8)]
        append(spark, database, everything)
        appended.compact(spark, database, most_batches=most)
        per_band = {}
        for _, band in directories(spark, database):
            per_band[band] = per_band.get(band, 0) + 1
        assert max(per_band.values()) <= most
    assert found(spark, database) == sorted(everything)
    assert ingest.saved_watermark(spark, database, "order_items") == everything[-1][0]
    assert append(spark, database, everything) == everything[-1][0]  # nothing new
    assert found(spark, database) == sorted(everything)


def test_a_band_without_order_ids_is_compacted_too(spark, database):
    for last in (2, 4, 6):
        append(spark, database, [(i, None if i % 2 else 1) for i in range(1, last + 1)])
    assert appended.compact(spark, database, most_batches=2) == 2
    counted = appended.imported(spark, database)
    assert counted.count() == 6 and counted.where("order_item_order_id IS NULL").count() == 3
    assert len(directories(spark, database)) == 2


def test_files_stay_sorted_and_a_hot_order_is_cut(spark, database):
    items = [(i, 5 if i % 3 else i % 10) for i in range(1, 400)]
    append(spark, database, items[:200])
    append(spark, database, items)
    assert appended.compact(spark, database, most_batches=1, rows_per_file=100) == 1
    kept = appended.committed_rows(spark, database).select(
        F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("n"), "order_item_order_id"
    ).orderBy("f", "n").collect()
    assert len({r.f for r in kept}) >= 3
    assert all(a.f != b.f or a[2] <= b[2] for a, b in zip(kept, kept[1:]))


@pytest.mark.parametrize("when", ["before the switch", "after the switch"])
def test_a_stopped_compaction(spark, database, monkeypatch, when):
    items = [(i, i % 20) for i in range(1, 40)]
    append(spark, database, items[:20])
    append(spark, database, items)
    if when == "before the switch":
        monkeypatch.setattr(appended, "_insert", lambda *a: (_ for _ in ()).throw(RuntimeError("stop")))
    else:
        monkeypatch.setattr(appended, "_retire", lambda *a: (_ for _ in ()).throw(RuntimeError("stop")))
    with pytest.raises(RuntimeError):
        appended.compact(spark, database, most_batches=1)
    assert found(spark, database) == sorted(items)
    monkeypatch.undo()
    appended.compact(spark, database, most_batches=1)
    assert found(spark, database) == sorted(items)
    assert len(directories(spark, database)) == 2


def test_reset_hides_the_rows_at_once(spark, database, monkeypatch):
    append(spark, database, [(1, 1), (2, 2)])
    monkeypatch.setattr(ingest, "truncate", lambda *a: (_ for _ in ()).throw(RuntimeError("stop")))
    with pytest.raises(RuntimeError):
        ingest.reset_incremental(spark, database)
    assert found(spark, database) == []
    assert append(spark, database, [(1, 1), (2, 2)]) == 2
    assert found(spark, database) == [(1, 1), (2, 2)]


def test_tables_without_bands(spark, database):
    reader = FrameReader({"notes": spark.createDataFrame([(1, "a"), (2, "b")], "id long, note string")})
    for _ in range(2):
        mark = ingest.incremental_append(spark, reader, database, "notes", "id", cluster_by=None)
        assert mark == 2
    assert values(appended.imported(spark, database, "notes"), "*") == [(1, "a"), (2, "b")]
    assert appended.compact(spark, database, "notes", "id", "id") == 0


def test_a_table_of_another_layout_is_refused(spark, database):
    frames(spark)["order_items"].write.saveAsTable(f"{database}.order_items")
    with pytest.raises(ValueError, match="no batches"):
        append(spark, database, [(1, 1)])
