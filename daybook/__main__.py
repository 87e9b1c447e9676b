"""Command line, for ``spark-submit`` or ``python -m daybook``.

    python -m daybook run     --database shop --run-date 2021-03-02 --source source.properties
    python -m daybook reports --database shop --run-date 2021-03-02

The properties file holds the options of Spark's JDBC source, one ``key=value``
per line; nothing of it is stored.
"""

from __future__ import annotations

import argparse
from datetime import date
from pathlib import Path

from pyspark import SparkConf
from pyspark.sql import SparkSession

from daybook.plans import jobs
from daybook.session import apply_cluster_settings, require_persistent_catalog, shared_dir
from daybook.sources.readers import JdbcReader

COMMANDS = {
    "run": jobs.run,
    "daily": jobs.run_daily,
    "bootstrap": jobs.run_bootstrap,
    "reports": jobs.run_reports,
}


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="daybook")
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--database", required=True)
    parser.add_argument("--run-date", type=date.fromisoformat, default=date.today())
    parser.add_argument("--lag-days", type=int, default=1)
    parser.add_argument("--source", type=Path, help="properties file of the JDBC source")
    parser.add_argument("--import-tasks", type=int, default=2)
    parser.add_argument("--concurrent-steps", type=int, default=6)
    parser.add_argument("--rebase-anchor", type=date.fromisoformat)
    parser.add_argument("--database-location")
    return parser.parse_args(arguments)


def source_options(path: Path) -> dict[str, str]:
    lines = (line.strip() for line in path.read_text().splitlines())
    pairs = (line.split("=", 1) for line in lines if line and not line.startswith("#"))
    return {key.strip(): value.strip() for key, value in pairs}


def session() -> SparkSession:
    """A session on the Hive metastore, unless the submitted job names another catalog."""
    given = SparkConf()
    builder = SparkSession.builder.appName("daybook")
    named = ("spark.sql.catalogImplementation", "spark.sql.catalog.spark_catalog")
    if not any(given.contains(key) for key in named):
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def main(arguments: list[str] | None = None) -> dict[str, int]:
    args = parse(arguments)
    spark = session()
    apply_cluster_settings(spark)
    require_persistent_catalog(spark)
    shared_dir(spark)  # fails before anything is read
    reader = JdbcReader(spark, source_options(args.source)) if args.source else None
    config = jobs.JobConfig(
        args.database,
        reader,
        args.lag_days,
        args.import_tasks,
        rebase_anchor=args.rebase_anchor,
        concurrent_steps=args.concurrent_steps,
        database_location=args.database_location,
    )
    written = COMMANDS[args.command](spark, config, args.run_date)
    for report, rows in written.items():
        print(f"{report}: {rows} rows")
    return written


if __name__ == "__main__":
    main()
