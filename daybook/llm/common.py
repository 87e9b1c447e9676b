"""What the operators share: stored steps, hashing to the unit interval, running totals."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.session import shared_dir

# The characters that end a word: space and the ASCII controls tab to return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, release: bool = True) -> DataFrame:
    """Write a frame to the shared folder and read it from there.

    Later steps then neither repeat the work nor depend on any one executor.
    The files stay until whoever owns the shared folder clears it. What the step
    shuffled is needed no more; Spark removes shuffle files once the driver's JVM
    has let go of their plan, so it is asked to look for garbage; small steps
    switch that off by ``release``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if release:
        gc.collect()
        spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def discard(stored_frame: DataFrame) -> None:
    """Remove the files of a stored frame that nothing reads any more."""
    spark = stored_frame.sparkSession
    folders = {file.rsplit("/", 1)[0] for file in stored_frame.inputFiles()}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that gives the memory of batches it is done with back.

    Arrow's pool keeps it otherwise, and Python workers stay for a while after their
    tasks, when the executor needs the memory for something else.
    """

    def task(batches: Iterator) -> Iterator:
        pool = pa.default_memory_pool()

        def each() -> Iterator:
            for batch in batches:
                yield batch
                del batch
                pool.release_unused()

        yield from run(each())
        pool.release_unused()

    return task


# Up to this many keys of 8 bytes are sent to every executor; more meet in a shuffle.
BROADCAST_ROWS = 1_000_000


def small_side(keys: DataFrame) -> DataFrame:
    """A stored frame of keys, to be broadcast if its counted rows are few enough."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def unit(*cols: Column | str) -> Column:
    """A hash of the columns as a double in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def bucket_count(rows: int, per_bucket: int = 20_000) -> int:
    return max(1, -(-rows // per_bucket))


def with_running_total(
    df: DataFrame,
    out: str,
    group: Sequence[str],
    spread: Column,
    order: Sequence[Column | str],
    value: Column,
    buckets: int,
) -> DataFrame:
    """Add the sum of ``value`` over the rows before this one in its group.

    ``spread`` lies in [0, 1) and gives the main order; it also cuts each group
    into ``buckets`` ranges, so that no task holds a whole group. Totals of the
    ranges, one row each, then give every range its offset. The result depends
    on the rows alone, not on how they are partitioned.
    """
    at = F.least(F.floor(spread * buckets), F.lit(buckets - 1)).cast("long")
    ranged = df.withColumns({"_u": spread, "_range": at, "_value": value})
    keys = [*group, "_range"]
    totals = ranged.groupBy(*keys).agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)],
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"),
    )
    inside = Window.partitionBy(*keys).orderBy("_u", *order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = ranged.withColumn("_local", F.sum("_value").over(inside) - F.col("_value"))
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)]
    joined = local.join(offsets, same)
    return joined.select(*df.columns, (F.col("_offset") + F.col("_local")).alias(out))
