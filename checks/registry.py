"""Registry of the queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from daybook.context import RunContext
from daybook.sources.samples import SampleTables

# Periods the queries report on; both lie inside the sample data.
DAILY = RunContext(date(2000, 2, 4))
MONTHLY = RunContext(date(1998, 6, 1))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str) -> Callable:
    """Register a function of the sample tables together with its SQL."""

    def register(build: Callable[[SampleTables], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(SampleTables(spark, sf_dir))

        run.__name__ = name
        QUERIES[name], ORACLE[name] = run, sql
        return build

    return register
