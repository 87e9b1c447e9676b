"""Reports of one run, written apart and switched to together.

Each report goes into a folder of its own version. When all are there, the partition
of each report table is pointed at its folder: catalog changes only, one after the
other, with no data moved in between. If a report fails, nothing has been switched and
every table shows what it showed before.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.schemas import REPORT_TABLES
from daybook.sinks.tables import drop_partition, ensure_report_table, remove_folder, table_location


@dataclass(frozen=True)
class Staged:
    """One report's rows, not yet visible."""

    table: str
    column: str
    period: str
    folder: str
    rows: int


@dataclass
class Publication:
    """The reports that one run switches to."""

    spark: SparkSession
    database: str
    version: str = field(default_factory=lambda: f"{time.time_ns()}-{uuid.uuid4().hex[:8]}")
    staged: dict[str, Staged] = field(default_factory=dict)

    def _periods(self, report: str, period: str) -> str:
        root = self.spark.catalog.getDatabase(self.database).locationUri.rstrip("/")
        return f"{root}/report_versions/{REPORT_TABLES[report].name}/{period}"

    def stage(self, df: DataFrame, report: str, period: str) -> int:
        """Write a report apart; returns the number of its rows."""
        layout = REPORT_TABLES[report]
        table = ensure_report_table(self.spark, self.database, report)
        folder = f"{self._periods(report, period)}/{self.version}"
        written = Observation()
        rows = df.select(*layout.columns.names).observe(written, F.count(F.lit(1)).alias("rows"))
        rows.write.parquet(folder)
        count = written.get["rows"]
        self.staged[report] = Staged(table, layout.period_column, period, folder, count)
        return count

    def publish(self) -> None:
        """Point every staged period at its folder; an empty report empties its period.

        All tables are switched at the same time, from as many threads; what the new
        versions replace is removed after the last one.
        """
        with ThreadPoolExecutor(max(1, len(self.staged))) as pool:
            list(pool.map(self._switch, self.staged.values()))
            list(pool.map(self._clean, self.staged))

    def _switch(self, one: Staged) -> None:
        if one.rows == 0:
            drop_partition(self.spark, one.table, one.column, one.period)
            return
        spec = f"PARTITION (`{one.column}` = '{one.period}')"
        self.spark.sql(f"ALTER TABLE {one.table} ADD IF NOT EXISTS {spec} LOCATION '{one.folder}'")
        self.spark.sql(f"ALTER TABLE {one.table} {spec} SET LOCATION '{one.folder}'")

    def _clean(self, report: str) -> None:
        one = self.staged[report]
        self.spark.catalog.refreshTable(one.table)
        place = table_location(self.spark, one.table)
        remove_folder(self.spark, f"{place}/{one.column}={one.period}")
        self._remove_older(self._periods(report, one.period))

    def discard(self) -> None:
        """Remove what was staged and is not to be shown."""
        for one in self.staged.values():
            remove_folder(self.spark, one.folder)
        self.staged.clear()

    def _remove_older(self, folder: str) -> None:
        """Keep this version and the one before it, for readers still at work."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        versions = sorted(entry.getPath().getName() for entry in files.listStatus(path))
        for old in [v for v in versions if v < self.version][:-1]:
            remove_folder(self.spark, f"{folder}/{old}")
