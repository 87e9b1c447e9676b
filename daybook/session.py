"""Session settings and the shared scratch area."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for large clusters, applied where the submitted job sets nothing else.
CLUSTER_SETTINGS = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed ones,
    # switch to a broadcast join once the real size of a side is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key also where the sums after the join then need a shuffle more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Start wide; adaptive execution merges what turns out small.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Spark broadcasts a side of at most 10 MB of files, or 64 MB as measured in a
    # shuffle. Files can be many times smaller than their rows in memory, so the
    # first bound is the tighter one, and sizes of plain files are scaled up.
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.fileCompressionFactor": "4",
    # Hash instead of sort where every partition of a side is measured to be small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # One period of orders filters the item scan before the shuffle, also when
    # that period is too large to broadcast.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "8g",
    # Without column statistics Spark takes the expected sizes, so these are what
    # counts: 8 bits for each of 20 million orders, 20 MB, merged in one task.
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "20000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "160000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "20000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "160000000",
    # A load replaces only the partitions it has rows for.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def apply_cluster_settings(spark: SparkSession) -> None:
    given = spark.sparkContext.getConf()
    for key, value in CLUSTER_SETTINGS.items():
        if not given.contains(key):
            spark.conf.set(key, value)


def require_persistent_catalog(spark: SparkSession) -> None:
    """Refuse a catalog that ends with the process: the next run would find no warehouse."""
    kind = spark.conf.get("spark.sql.catalogImplementation", "in-memory")
    if kind == "in-memory" and not spark.conf.get("spark.sql.catalog.spark_catalog", None):
        raise ValueError(
            "the catalog is in memory and ends with this process; configure a Hive metastore "
            "(spark.sql.catalogImplementation=hive) or spark.sql.catalog.spark_catalog"
        )


def require_dynamic_overwrite(spark: SparkSession) -> None:
    """Make ``INSERT OVERWRITE`` replace single partitions, not whole tables.

    ``insertInto`` ignores the per-write option of that name, and the session
    default would clear every other partition. The setting is therefore put on
    the session and stays there: restoring it could race with another thread.
    """
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``.

    A temporary folder stands in only for a local master, where the driver is
    the one executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_scratch()


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def create_scratch_database(spark: SparkSession) -> str:
    """New database below the shared folder; dropping it removes its files."""
    name = f"daybook_scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark)}/{name}'")
    return name


def drop_scratch_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
