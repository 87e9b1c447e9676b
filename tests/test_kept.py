"""Daily sums kept for the monthly report: what is read, and what makes a day stale."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from shop import DAY, OTHER_DAY, ROWS, frames, rows

from daybook.context import RunContext
from daybook.operators.facts import JoinAudit, customer_sales_fact, day_totals
from daybook.operators.scans import orders_for_day, orders_for_month
from daybook.plans import jobs, kept, reports
from daybook.sinks.kept import CUSTOMER_SUMS, LEDGER, kept_days
from daybook.sinks.tables import qualified
from daybook.sources import appended, ingest
from daybook.sources.readers import FrameReader

APRIL = RunContext(date(2021, 4, 1))
SECOND, THIRD = date(2021, 3, 2), date(2021, 3, 3)


def reader(spark, **overrides):
    model = frames(spark, **overrides)
    return FrameReader({**model, "orders": model["orders"].drop("dt")})


@pytest.fixture
def shop(spark, database):
    """A warehouse whose two days have been run."""
    config = jobs.JobConfig(database, reader(spark))
    for day in (SECOND, THIRD):
        jobs.run_daily(spark, config, day)
    return config


def ledger(spark, database):
    return kept_days(spark, database, "2021-03-01", "2021-04-01")


def from_items(spark, database):
    """Spend by customer straight from the warehouse's rows."""
    orders = orders_for_month(spark.table(f"{database}.orders"), APRIL)
    fact = customer_sales_fact(
        orders, appended.imported(spark, database),
        spark.table(f"{database}.products"), spark.table(f"{database}.categories"),
    )
    return totals(fact)


def totals(sums):
    found = sums.groupBy("customer_id").agg(F.round(F.sum("order_item_subtotal"), 2).alias("s"))
    return rows(found, "customer_id", "s")


def month(spark, database, monkeypatch):
    """(spend by customer, days that were built) of the monthly sums."""
    built, build = [], kept._build_days
    monkeypatch.setattr(kept, "_build_days", lambda s, d, c, days: built.extend(days) or build(s, d, c, days))
    sums = kept.month_customer_sums(spark, database, APRIL)
    monkeypatch.setattr(kept, "_build_days", build)
    return totals(sums), [day for day in built if day in (DAY, OTHER_DAY)], sums


def test_kept_days_are_not_read_again(spark, shop, monkeypatch):
    database = shop.database
    assert set(ledger(spark, database)) == {DAY, OTHER_DAY}
    found, built, _ = month(spark, database, monkeypatch)
    assert built == [] and found == from_items(spark, database)
    found, built, sums = month(spark, database, monkeypatch)
    assert len(ledger(spark, database)) == 31 and found == from_items(spark, database)
    text = reports.top_customers_month(sums, spark.table(f"{database}.customers"), APRIL)._jdf.queryExecution().toString()
    assert "order_item_id" not in text and "order_id" not in text and CUSTOMER_SUMS in text


def test_the_job_writes_the_month_from_them(spark, shop):
    written = jobs.run_reports(spark, shop, APRIL.run_date)
    expected = reports.top_customers_month(
        customer_sales_fact(
            orders_for_month(spark.table(f"{shop.database}.orders"), APRIL),
            appended.imported(spark, shop.database),
            spark.table(f"{shop.database}.products"), spark.table(f"{shop.database}.categories"),
        ),
        spark.table(f"{shop.database}.customers"), APRIL,
    )
    assert written["top_customers_month"] == 4
    assert rows(spark.table(f"{shop.database}.top5_custs_monthly"), "*") == rows(expected, "*")


def test_missing_days_are_built(spark, database, monkeypatch):
    source = reader(spark)
    ingest.load_orders_partitions(spark, frames(spark)["orders"], database)
    for table in ingest.SNAPSHOT_KEYS:
        ingest.snapshot_import(spark, source, database, table)
    ingest.incremental_append(spark, source, database)
    found, built, _ = month(spark, database, monkeypatch)
    assert built == [DAY, OTHER_DAY] and found == from_items(spark, database) and found
    assert month(spark, database, monkeypatch)[1] == []


def test_an_imported_day_is_stale(spark, shop, monkeypatch):
    changed = [(*row[:3], "CANCELED", row[4]) if row[0] == 1 else row for row in ROWS["orders"]]
    ingest.import_orders_day(spark, reader(spark, orders=changed), shop.database, DAY)
    found, built, _ = month(spark, shop.database, monkeypatch)
    assert built == [DAY] and found == from_items(spark, shop.database)


def test_a_back_fill_of_unknown_days_makes_all_stale(spark, shop):
    ingest.load_orders_partitions(spark, frames(spark)["orders"], shop.database)
    assert ledger(spark, shop.database) == {}


def test_late_items_make_their_day_stale(spark, shop, monkeypatch):
    late = [*ROWS["order_items"], (14, 2, 102, 1, 5.5), (15, 3, 100, 1, 7.0)]  # order 3 is cancelled
    ingest.incremental_append(spark, reader(spark, order_items=late), shop.database)
    found, built, _ = month(spark, shop.database, monkeypatch)
    assert built == [DAY] and found == from_items(spark, shop.database)
    later = [*late, (16, 9, 100, 1, 1.25), (17, 4000, 100, 1, 1.25)]
    ingest.incremental_append(spark, reader(spark, order_items=later), shop.database)
    found, built, _ = month(spark, shop.database, monkeypatch)
    assert built == [OTHER_DAY] and found == from_items(spark, shop.database)


def test_items_of_other_orders_change_no_day(spark, shop, monkeypatch):
    more = [*ROWS["order_items"], (14, 3, 100, 1, 7.0), (15, 4000, 100, 1, 1.0)]
    ingest.incremental_append(spark, reader(spark, order_items=more), shop.database)
    assert month(spark, shop.database, monkeypatch)[1] == []


@pytest.mark.parametrize(
    "products, stale",
    [
        # One more product: the first day has items without one, so it might matter there.
        ([*ROWS["products"], (105, 10, "new")], [DAY]),
        # The second day sold product 100 only.
        ([p for p in ROWS["products"] if p[0] != 100], [DAY, OTHER_DAY]),
        ([p for p in ROWS["products"] if p[0] != 102], [DAY]),
        ([*ROWS["products"], (100, 11, "twice")], [DAY, OTHER_DAY]),
        # Another name or another category that exists is no change of the sums.
        ([(100, 11, "lamp"), *ROWS["products"][1:]], []),
    ],
)
def test_changes_of_the_catalog(spark, shop, monkeypatch, products, stale):
    ingest.snapshot_import(spark, reader(spark, products=products), shop.database, "products")
    found, built, _ = month(spark, shop.database, monkeypatch)
    assert built == stale and found == from_items(spark, shop.database)


def test_compaction_keeps_the_days(spark, shop, monkeypatch):
    assert appended.compact(spark, shop.database, most_batches=1) >= 0
    assert month(spark, shop.database, monkeypatch)[1] == []


def test_reset_forgets_all_days(spark, shop):
    ingest.reset_incremental(spark, shop.database)
    assert ledger(spark, shop.database) == {}


def test_sums_without_a_ledger_row_are_not_read(spark, shop, monkeypatch):
    """A job that stopped after the sums and before the ledger."""
    monkeypatch.setattr(kept, "write_ledger", lambda *a: (_ for _ in ()).throw(RuntimeError("stop")))
    with pytest.raises(RuntimeError):
        jobs.run_reports(spark, shop, SECOND)
    monkeypatch.undo()
    assert set(ledger(spark, shop.database)) == {OTHER_DAY}
    found, built, _ = month(spark, shop.database, monkeypatch)
    assert built == [DAY] and found == from_items(spark, shop.database)


def test_audit_counts_what_each_join_leaves(spark, shop):
    """The ledger's counts, made in the pass itself, equal those of SQL."""
    for name in ("orders", "products", "categories"):
        spark.table(f"{shop.database}.{name}").createOrReplaceTempView(f"audit_{name}")
    appended.imported(spark, shop.database).createOrReplaceTempView("audit_items")
    for day, row in ledger(spark, shop.database).items():
        joins = (
            f"(SELECT * FROM audit_orders WHERE dt = '{day}' AND order_status NOT IN ('CANCELED', 'ON_HOLD')) o "
            "JOIN audit_items i ON order_id = order_item_order_id "
        )
        product = "JOIN audit_products ON product_id = order_item_product_id "
        category = "JOIN audit_categories ON category_id = product_category_id"
        want = [
            spark.sql(f"SELECT count(*) FROM {j}").first()[0]
            for j in (joins, joins + product, joins + product + category)
        ]
        assert [row.sold, row.with_product, row.with_category] == want
        assert row.complete == (len(set(want)) == 1)
    assert spark.table(qualified(shop.database, LEDGER)).count() == 2


def test_a_day_whose_orders_have_no_items(spark, shop, monkeypatch):
    orders = [*ROWS["orders"], (70, "2021-03-05", 1, "COMPLETE", "2021-03-05")]
    config = jobs.JobConfig(shop.database, reader(spark, orders=orders))
    written = jobs.run_daily(spark, config, date(2021, 3, 6))
    assert written["order_status"] == 1 and written["top_customers_day"] == 0
    row = ledger(spark, shop.database)["2021-03-05"]
    assert (row.low, row.high) == (70, 70) and row.sold in (0, None)
    found, built, _ = month(spark, shop.database, monkeypatch)
    assert built == [] and found == from_items(spark, shop.database)


def test_audit_does_not_change_the_totals(spark, shop):
    model = frames(spark)
    inputs = [orders_for_day(model["orders"], DAY), *[model[t] for t in ("order_items", "products", "categories")]]
    audited, audit = day_totals(*inputs, JoinAudit()), JoinAudit()
    assert rows(audited, "*") == rows(day_totals(*inputs), "*")
    day_totals(*inputs, audit).collect()
    assert audit.rows() == {"sold": 8, "with_product": 7, "with_category": 6}
