"""Split reads: ranges with equal numbers of rows, whatever the ids look like."""

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.sources.readers import JdbcReader, RangeReader, SourceFilter, Split
from daybook.sources.splits import Range, balanced_ranges


def counting(values):
    def count_buckets(first, width, buckets):
        inside = [v for v in values if first <= v < first + width * buckets]
        return Counter((v - first) // width for v in inside).items()

    return count_buckets


def shares(values, ranges):
    return [
        sum((r.low is None or v >= r.low) and (r.high is None or v < r.high) for v in values)
        for r in ranges
    ]


@pytest.mark.parametrize("tasks", [2, 3, 8])
def test_one_dense_range_far_from_the_rest(tasks):
    """Equal widths would give all but a few rows to one task."""
    values = [*range(1, 40), *range(10**15, 10**15 + 100_000)]
    ranges = balanced_ranges(values[0], values[-1], tasks, counting(values))
    found = shares(values, ranges)
    assert len(found) == tasks and sum(found) == len(values)
    assert max(found) - min(found) <= 0.05 * len(values) / tasks


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(-(10**12), 10**12), min_size=1, max_size=60), st.integers(1, 6))
def test_every_value_is_in_one_range(values, tasks):
    ranges = balanced_ranges(min(values), max(values), tasks, counting(values))
    assert 1 <= len(ranges) <= tasks
    assert sum(shares(values, ranges)) == len(values) and all(shares(values, ranges))
    assert ranges[0].low is None and ranges[-1].high is None
    assert all(a.high == b.low for a, b in zip(ranges, ranges[1:]))


def test_one_value_cannot_be_cut():
    values = [5] * 1000 + [6, 7, 8]
    assert shares(values, balanced_ranges(5, 8, 4, counting(values)))[0] == 1000


def test_nulls_go_with_the_first_range():
    assert Range(None, 5).sql("c") == "(c < 5 OR c IS NULL)"
    assert Range(5, None).sql("c") == "c >= 5"
    assert Range(None, None).sql("c") == "(1 = 1 OR c IS NULL)"


@pytest.fixture(scope="module")
def dense(spark):
    """Ids of an old, sparse time and a new, dense one; some null."""
    rng = random.Random(3)
    ids = [i * 1_000_003 for i in range(100)] + [10**9 + i for i in range(5000)]
    rng.shuffle(ids)
    rows = [(i, f"r{i}") for i in ids] + [(None, "no id")] * 3
    return spark.createDataFrame(rows, "id long, name string")


def task_sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_frames_are_read_in_equal_ranges(spark, dense, tmp_path):
    """One file gives one task by itself, and as many as there are ranges when split."""
    dense.coalesce(1).write.parquet(str(tmp_path / "dense"))
    reader = RangeReader({"t": spark.read.parquet(str(tmp_path / "dense"))})
    df = reader.read("t", None, Split("id", 4))
    sizes = task_sizes(df)
    assert len(sizes) == 4 and sum(sizes) == 5103 and sizes[-1] - sizes[0] < 150
    newer = SourceFilter.greater("id", 10**9)
    parts = [part.count() for part in reader.parts("t", newer, Split("id", 2))]
    assert len(parts) == 2 and sum(parts) == 4999 and abs(parts[0] - parts[1]) < 200
    empty = RangeReader({"t": dense.where("false")}).read("t", None, Split("id", 2))
    assert empty.count() == 0


def test_a_database_is_read_in_equal_tasks(spark, dense):
    """The same table in an embedded database inside Spark's own JVM."""
    options = {
        "url": "jdbc:derby:memory:splits;create=true",
        "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
    }
    dense.write.format("jdbc").options(**options, dbtable="dense").save()
    reader = JdbcReader(spark, options)
    df = reader.read("dense", None, Split("id", 4))
    sizes = task_sizes(df)
    assert df.rdd.getNumPartitions() == 4 and sum(sizes) == 5103
    assert sizes[-1] - sizes[0] < 150
    equal_widths = spark.read.format("jdbc").options(
        **options, dbtable="dense", partitionColumn="id", lowerBound="0",
        upperBound=str(10**9 + 5000), numPartitions="4",
    ).load()
    assert task_sizes(equal_widths)[-1] >= 5000
    newer = reader.read("dense", SourceFilter.greater("id", 10**9 + 99), Split("id", 2))
    sizes = task_sizes(newer)
    assert len(sizes) == 2 and sum(sizes) == 4900 and sizes[1] - sizes[0] < 200
