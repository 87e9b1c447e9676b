"""Databases, tables and partition replacement."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.periods import with_period
from daybook.schemas import MODEL, REPORT_TABLES
from daybook.session import require_dynamic_overwrite


def qualified(database: str, table: str) -> str:
    return f"{database}.{table}"


def database_exists(spark: SparkSession, database: str) -> bool:
    return spark.catalog.databaseExists(database)


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")


def ensure_partitioned_table(
    spark: SparkSession, table: str, columns: T.StructType, partition: str
) -> None:
    """Parquet table with string column ``partition`` as its only partition column."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in columns if f.name != partition]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(fields)}, `{partition}` STRING) "
        f"USING parquet PARTITIONED BY (`{partition}`)"
    )


def ensure_orders_table(spark: SparkSession, database: str) -> str:
    table = qualified(database, "orders")
    ensure_partitioned_table(spark, table, MODEL["orders"], "dt")
    return table


def ensure_report_table(spark: SparkSession, database: str, report: str) -> str:
    layout = REPORT_TABLES[report]
    table = qualified(database, layout.name)
    ensure_partitioned_table(spark, table, layout.columns, layout.period_column)
    return table


def drop_partition(spark: SparkSession, table: str, column: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{column}` = '{value}')")


def insert_partitions(df: DataFrame, table: str, columns: list[str]) -> None:
    """Replace exactly the partitions that occur in ``df``; an empty frame changes nothing.

    Rows are matched by position, so the columns are put in table order first.
    New files are staged and swapped in at commit: when a job fails, the old
    partitions are still there.
    """
    require_dynamic_overwrite(df.sparkSession)
    df.select(*columns).write.mode("overwrite").insertInto(table)


def replace_period(df: DataFrame, table: str, column: str, value: str) -> int:
    """Make ``df`` the content of one period; other periods are left alone.

    Gives the same table however often it runs. An empty result leaves the
    period empty. Returns the number of rows written.
    """
    spark = df.sparkSession
    columns = spark.table(table).columns
    written = Observation()
    rows = with_period(df, column, value).observe(written, F.count(F.lit(1)).alias("rows"))
    insert_partitions(rows, table, columns)
    if written.get["rows"] == 0:
        drop_partition(spark, table, column, value)
    return written.get["rows"]


def replace_report(df: DataFrame, database: str, report: str, value: str) -> int:
    layout = REPORT_TABLES[report]
    table = ensure_report_table(df.sparkSession, database, report)
    return replace_period(df, table, layout.period_column, value)


def add_missing_columns(df: DataFrame, table: str, but: tuple[str, ...] = ()) -> DataFrame:
    """Add columns that the table lacks to it, and those that ``df`` lacks to ``df`` as nulls."""
    spark = df.sparkSession
    known = set(spark.table(table).columns)
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")
    missing = [f for f in spark.table(table).schema if f.name not in (*df.columns, *but)]
    empty = {f.name: F.lit(None).cast(f.dataType) for f in missing}
    return df.withColumns(empty) if empty else df


def partition_values(spark: SparkSession, table: str) -> list[dict[str, str | None]]:
    """Values of the partition columns of every directory, from the catalog alone."""
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        pairs = [part.split("=", 1) for part in row[0].split("/")]
        found.append(
            {name: None if value == "__HIVE_DEFAULT_PARTITION__" else value for name, value in pairs}
        )
    return found


def drop_partitions(spark: SparkSession, table: str, which: list[dict[str, str | None]]) -> None:
    """Drop directories by the values of all their partition columns."""
    for at in range(0, len(which), 500):
        specs = [
            ", ".join(f"`{k}` = {'NULL' if v is None else repr(v)}" for k, v in spec.items())
            for spec in which[at : at + 500]
        ]
        listed = ", ".join(f"PARTITION ({spec})" for spec in specs)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {listed}")


def table_property(spark: SparkSession, table: str, name: str) -> str | None:
    """One property of a table or view; None if that, or the table, is absent."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return next((row["value"] for row in rows if row["key"] == name), None)


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").collect()
    return next(row["data_type"] for row in rows if row["col_name"] == "Location").rstrip("/")


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_VERSION, _BEFORE = "daybook.version", "daybook.version_before"


def publish_version(df: DataFrame, database: str, table: str) -> None:
    """Write a whole table into a new version folder and switch its name to it.

    The name is a view over one version, and replacing the view is one change in the
    catalog, whether or not the columns differ: readers find the old version or the new
    one, never none. The view tells its version and the one before; those two stay, for
    readers still at work, and what any other run left is removed. A write that fails
    removes its own folder and leaves the view alone.
    """
    spark, name = df.sparkSession, qualified(database, table)
    root = f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}_versions"
    version = f"{time.time_ns()}-{uuid.uuid4().hex[:8]}"
    try:
        df.write.parquet(f"{root}/{version}")
    except Exception:
        remove_folder(spark, f"{root}/{version}")
        raise
    live = table_property(spark, name, _VERSION)
    columns = ", ".join(f"`{c}`" for c in df.columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_VERSION}' = '{version}', "
        f"'{_BEFORE}' = '{live or ''}') AS SELECT {columns} FROM parquet.`{root}/{version}`"
    )
    _remove_versions(spark, root, keep={version, live})


def version_before(spark: SparkSession, database: str, table: str) -> DataFrame | None:
    """The rows that the last import of a snapshot replaced, or None."""
    before = table_property(spark, qualified(database, table), _BEFORE)
    if not before:
        return None
    folder = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    return spark.read.parquet(f"{folder}/{table}_versions/{before}")


def _remove_versions(spark: SparkSession, root: str, keep: set[str | None]) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in files.listStatus(path):
        if entry.getPath().getName() not in keep:
            files.delete(entry.getPath(), True)


def truncate(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")
