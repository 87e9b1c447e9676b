"""The steps of runs, so that a run that stopped goes on where it was."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.sinks.tables import ensure_partitioned_table, insert_partitions, qualified

RUNS = "run_steps"
# Fixed value: the row that closes a run; no step has this name.
WHOLE_RUN = "run"
_COLUMNS = T.StructType(
    [T.StructField("step", T.StringType()), T.StructField("rows", T.LongType())]
)


class RunLedger:
    """The finished steps of one run date, one partition that each step replaces as a whole.

    A run that was closed begins anew, so running a date again imports it again; one
    that stopped keeps what it finished. Steps end in several threads: their rows are
    written one after the other, each after its step's own commit, so a step whose row
    is missing is done twice at most, and every step may be.
    """

    def __init__(self, spark: SparkSession, database: str, run_date: str) -> None:
        self.spark, self.run_date, self.lock = spark, run_date, threading.Lock()
        self.table = qualified(database, RUNS)
        ensure_partitioned_table(spark, self.table, _COLUMNS, "run_date")
        mine = spark.table(self.table).where(F.col("run_date") == run_date)
        steps = {row["step"]: row["rows"] for row in mine.collect()}
        self.steps: dict[str, int | None] = {} if WHOLE_RUN in steps else steps

    def finished(self, step: str) -> bool:
        return step in self.steps

    def rows(self, step: str) -> int | None:
        return self.steps[step]

    def finish(self, step: str, rows: int | None = None) -> None:
        self.finish_all({step: rows})

    def finish_all(self, steps: dict[str, int | None]) -> None:
        with self.lock:
            self.steps |= steps
            schema = T.StructType([*_COLUMNS.fields, T.StructField("run_date", T.StringType())])
            values = [(name, count, self.run_date) for name, count in self.steps.items()]
            written = self.spark.createDataFrame(values, schema).coalesce(1)
            insert_partitions(written, self.table, schema.names)

    def close(self) -> None:
        """Declare the run finished; the next one of this date does every step."""
        self.finish(WHOLE_RUN)
