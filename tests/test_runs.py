"""Runs that stop and go on: what is read again, and what is not."""

from collections import Counter
from dataclasses import dataclass, field
from datetime import date

import pytest
from shop import DAY, OTHER_DAY, ROWS, frames, rows

from daybook.plans import jobs
from daybook.schemas import REPORT_TABLES
from daybook.sinks import tables
from daybook.sinks.publish import Publication
from daybook.sinks.runs import RUNS, RunLedger
from daybook.sources.readers import FrameReader

RUN = date(2021, 3, 2)


@dataclass
class CountingReader:
    """Counts the reads of every table; those in ``broken`` fail."""

    inner: FrameReader
    broken: set = field(default_factory=set)
    reads: Counter = field(default_factory=Counter)

    def read(self, table, where=None, split=None):
        self.reads[table] += 1
        if table in self.broken:
            raise ConnectionError(table)
        return self.inner.read(table, where, split)


@pytest.fixture
def source(spark):
    model = frames(spark)
    return CountingReader(FrameReader({**model, "orders": model["orders"].drop("dt")}))


def test_a_run_stopped_between_two_imports_goes_on(spark, database, source, monkeypatch):
    config = jobs.JobConfig(database, source, concurrent_steps=1)
    source.broken = {"products"}
    with pytest.raises(ConnectionError):
        jobs.run_daily(spark, config, RUN)
    assert set(source.reads.values()) == {1} and len(source.reads) == 6
    assert not spark.catalog.tableExists(f"{database}.department_wise_sales")

    source.broken = set()
    written = jobs.run_daily(spark, config, RUN)
    assert source.reads == Counter(products=2) + Counter(
        ["orders", "order_items", "categories", "departments", "customers"]
    )
    assert written["department_sales"] == 2 and written["top_customers_day"] == 4

    # The run is closed: the same date again is a run of its own.
    assert jobs.run_daily(spark, config, RUN) == written
    assert source.reads["customers"] == 2 and source.reads["products"] == 3


ALL = {
    "category_sales": 3, "department_sales": 2, "top_products_qty": 4,
    "top_products_amount": 4, "top_customers_day": 4, "order_status": 5,
}


def shown(spark, database):
    """Everything the six report tables show."""
    names = [REPORT_TABLES[name].name for name in ALL]
    return {n: rows(spark.table(f"{database}.{n}"), "*") for n in names if spark.catalog.tableExists(f"{database}.{n}")}


def test_a_failed_report_leaves_all_at_the_old_state(spark, database, source, monkeypatch):
    """Orders change, the fifth report fails: all six tables still show the old day."""
    config = jobs.JobConfig(database, source, concurrent_steps=1)
    assert jobs.run_daily(spark, config, RUN) == ALL
    before = shown(spark, database)
    changed = [(*row[:3], "COMPLETE", row[4]) for row in ROWS["orders"]]
    model = {**source.inner.frames, "orders": frames(spark, orders=changed)["orders"].drop("dt")}
    source.inner = FrameReader(model)
    staged, stage = [], Publication.stage

    def failing(self, df, report, period):
        if len(staged) == 4:
            raise RuntimeError("stopped")
        staged.append(report)
        return stage(self, df, report, period)

    monkeypatch.setattr(Publication, "stage", failing)
    with pytest.raises(RuntimeError):
        jobs.run_daily(spark, config, RUN)
    assert len(staged) == 4 and shown(spark, database) == before
    monkeypatch.undo()

    # The run goes on: nothing is imported again, and all six change together.
    reads = Counter(source.reads)
    jobs.run_daily(spark, config, RUN)
    after = shown(spark, database)
    assert source.reads == reads and all(after[name] != before[name] for name in before)


def test_a_repeated_report_replaces_its_period_only(spark, database, source):
    config = jobs.JobConfig(database, source)
    for day in (RUN, date(2021, 3, 3), RUN, RUN):
        jobs.run_daily(spark, config, day)
    counts = rows(spark.table(f"{database}.department_wise_sales").groupBy("txn_date").count(), "*")
    assert counts == [(DAY, 2), (OTHER_DAY, 1)]
    folder = f"{spark.catalog.getDatabase(database).locationUri}/report_versions/department_wise_sales/{DAY}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert len(path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)) == 2
    # A period can still be replaced by itself, and emptied.
    table = f"{database}.department_wise_sales"
    one = spark.table(table).where(f"txn_date = '{DAY}' and department_id = 1")
    kept = spark.createDataFrame(one.collect(), one.schema)
    assert tables.replace_period(kept, table, "txn_date", DAY) == 1
    assert rows(spark.table(table), "department_id", "txn_date") == [(1, DAY), (1, OTHER_DAY)]
    tables.replace_period(kept.where("false"), table, "txn_date", DAY)
    assert rows(spark.table(table), "txn_date") == [(OTHER_DAY,)]


def test_an_empty_report_empties_its_period(spark, database, source):
    config = jobs.JobConfig(database, source)
    jobs.run_daily(spark, config, RUN)
    held = [(*row[:3], "ON_HOLD", row[4]) for row in ROWS["orders"]]
    model = {**source.inner.frames, "orders": frames(spark, orders=held)["orders"].drop("dt")}
    written = jobs.run_daily(spark, jobs.JobConfig(database, FrameReader(model)), RUN)
    assert written["category_sales"] == 0 and written["order_status"] == 1
    assert spark.table(f"{database}.category_wise_sales").count() == 0


def test_other_dates_and_reports_alone_have_no_part_in_it(spark, database, source):
    config = jobs.JobConfig(database, source)
    source.broken = {"products"}
    with pytest.raises(ConnectionError):
        jobs.run_daily(spark, config, RUN)
    source.broken = set()
    jobs.run_daily(spark, config, date(2021, 3, 3))
    assert source.reads["customers"] == 2
    jobs.run_reports(spark, config, RUN)
    steps = rows(spark.table(f"{database}.{RUNS}").where("run_date = '2021-03-02'"), "step")
    assert ("import customers",) in steps and ("run",) not in steps
    assert (DAY, 2) in rows(
        spark.table(f"{database}.department_wise_sales").groupBy("txn_date").count(), "*"
    )


def test_ledger(spark, database):
    first = RunLedger(spark, database, "2021-03-02")
    first.finish("a", 3)
    first.finish("b")
    again = RunLedger(spark, database, "2021-03-02")
    assert again.finished("a") and again.rows("a") == 3 and again.rows("b") is None
    assert not RunLedger(spark, database, "2021-03-03").finished("a")
    again.close()
    assert not RunLedger(spark, database, "2021-03-02").finished("a")
