from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from shop import rows

from daybook.functions import periods, rebase

ANCHOR = date(2022, 7, 17)


def days_before(n):
    return (ANCHOR - timedelta(days=n)).isoformat()


@pytest.mark.parametrize("kind", ["string", "date", "timestamp"])
def test_rebase_moves_exactly_the_window(spark, kind):
    offsets = [3280, 3279, 2979, 2915, 2914]
    source = spark.createDataFrame([(n, days_before(n)) for n in offsets], "n int, d string")
    source = source.withColumn("order_date", F.col("d").cast(kind))
    moved = rebase.rebase_order_dates(source, ANCHOR)
    assert moved.schema["order_date"].dataType == source.schema["order_date"].dataType
    result = dict(rows(moved, "n", F.col("order_date").cast("date")))
    expected = {n: date.fromisoformat(days_before(n if n in (3280, 2914) else n - 2979)) for n in offsets}
    assert result == expected


def test_rebase_leaves_other_values_alone(spark):
    values = ["", "not a date", days_before(3000) + " 10:00:00", None]
    source = spark.createDataFrame([(v,) for v in values], "order_date string")
    assert rows(rebase.rebase_order_dates(source, ANCHOR), "*") == rows(source, "*")


def test_source_days_invert_the_rebase(spark):
    span = [ANCHOR + timedelta(days=n) for n in range(-3400, 200)]
    source = spark.createDataFrame([(d, d) for d in span], "d date, order_date date")
    image = {}
    for d, moved in rows(rebase.rebase_order_dates(source, ANCHOR), "d", "order_date"):
        image.setdefault(moved, set()).add(d)
    for day in span[:3400]:
        assert set(rebase.source_days(day, ANCHOR)) == image.get(day, set())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_calendar_steps_ignore_clock_changes(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    run_days = ["2021-03-14", "2021-03-15", "2021-11-07", "2021-11-08", "2021-03-01", "2020-03-01"]
    df = spark.createDataFrame([(d,) for d in run_days], "d string")
    seconds = periods.epoch_seconds(F.col("d").cast("date"))
    back = periods.day_label(periods.day_from_epoch(seconds, 1))
    expected = [
        (d, (date.fromisoformat(d) - timedelta(days=1)).isoformat()) for d in sorted(run_days)
    ]
    assert rows(df, "d", back) == expected


def test_month_range_equals_month_prefix(spark):
    from daybook.context import RunContext

    ctx = RunContext(date(2021, 3, 1))
    days = [(date(2021, 1, 25) + timedelta(days=n)).isoformat() for n in range(60)]
    df = spark.createDataFrame([(d,) for d in days], "dt string")
    by_prefix = df.where(periods.month_prefix(F.col("dt")) == ctx.txn_month)
    assert rows(df.where(periods.in_month(F.col("dt"), ctx)), "dt") == rows(by_prefix, "dt")


@pytest.mark.parametrize("name", ["report_department_sales", "report_top_customers_month"])
def test_reports_do_not_depend_on_the_session_zone(spark, conf, name):
    from conftest import SAMPLES

    from __spark_entry__ import queries

    in_utc = rows(queries()[name](spark, SAMPLES), "*")
    conf("spark.sql.session.timeZone", "America/New_York")
    assert in_utc and rows(queries()[name](spark, SAMPLES), "*") == in_utc
