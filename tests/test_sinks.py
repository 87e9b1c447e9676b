import pytest
from pyspark.sql import functions as F
from shop import rows

from daybook.schemas import REPORT_TABLES
from daybook.sinks import tables

D1, D2 = "2021-03-01", "2021-03-02"


def sales(spark, *amounts):
    return spark.createDataFrame(
        [(i, f"dep{i}", float(a)) for i, a in enumerate(amounts)],
        "department_id int, department_name string, total_sales double",
    )


@pytest.fixture
def report(spark, database):
    return tables.ensure_report_table(spark, database, "department_sales")


def test_report_tables_have_the_fixed_layout(spark, database):
    for name, layout in REPORT_TABLES.items():
        table = tables.ensure_report_table(spark, database, name)
        tables.ensure_report_table(spark, database, name)
        assert spark.table(table).columns == layout.column_names
        assert [f.dataType for f in spark.table(table).schema][:-1] == [
            f.dataType for f in layout.columns
        ]
        partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
        assert partitions == [layout.period_column]


def test_rerun_replaces_one_period_only(spark, report):
    assert tables.replace_period(sales(spark, 1, 2), report, "txn_date", D1) == 2
    assert tables.replace_period(sales(spark, 5), report, "txn_date", D2) == 1
    for _ in range(2):
        tables.replace_period(sales(spark, 3), report, "txn_date", D1)
    assert rows(spark.table(report), "total_sales", "txn_date") == [(3.0, D1), (5.0, D2)]


def test_empty_result_clears_its_period_only(spark, report):
    tables.replace_period(sales(spark, 1, 2), report, "txn_date", D1)
    tables.replace_period(sales(spark, 5), report, "txn_date", D2)
    assert tables.replace_period(sales(spark, 9).where("false"), report, "txn_date", D1) == 0
    assert rows(spark.table(report), "total_sales", "txn_date") == [(5.0, D2)]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {report}").collect()] == [f"txn_date={D2}"]


def test_empty_result_found_only_at_run_time(spark, report):
    tables.replace_period(sales(spark, 1, 2), report, "txn_date", D1)
    nothing = sales(spark, 1).groupBy("department_id", "department_name").agg(
        F.sum("total_sales").alias("total_sales")
    )
    nothing = nothing.where("total_sales > 1000")
    assert tables.replace_period(nothing, report, "txn_date", D1) == 0
    assert spark.table(report).count() == 0


def test_failed_write_keeps_the_old_period(spark, report):
    tables.replace_period(sales(spark, 1, 2), report, "txn_date", D1)
    broken = sales(spark, 3).withColumn("total_sales", F.expr("1 / (department_id - 0)"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        tables.replace_period(broken, report, "txn_date", D1)
    assert rows(spark.table(report), "total_sales") == [(1.0,), (2.0,)]


def test_columns_are_put_in_table_order(spark, report):
    shuffled = sales(spark, 4).select("total_sales", "department_name", "department_id")
    tables.replace_period(shuffled, report, "txn_date", D1)
    assert rows(spark.table(report), "department_id", "department_name", "total_sales") == [
        (0, "dep0", 4.0)
    ]


def test_static_session_default_does_not_clear_other_periods(spark, conf, report):
    conf("spark.sql.sources.partitionOverwriteMode", "static")
    tables.replace_period(sales(spark, 1), report, "txn_date", D1)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    tables.replace_period(sales(spark, 2), report, "txn_date", D2)
    assert spark.table(report).count() == 2


def test_overflowing_id_is_refused(spark, database):
    table = tables.ensure_report_table(spark, database, "top_products_qty")
    big = spark.range(1).selectExpr(
        "2147483648L AS product_id", "'p' AS product_name", "1D AS total_qty"
    )
    with pytest.raises(Exception, match="(?i)overflow"):
        tables.replace_period(big, table, "txn_date", D1)


def test_drop_partition_and_databases(spark, database, report):
    tables.drop_partition(spark, report, "txn_date", D1)  # absent: no error
    tables.replace_period(sales(spark, 1), report, "txn_date", D1)
    tables.drop_partition(spark, report, "txn_date", D1)
    assert spark.table(report).count() == 0
    assert tables.database_exists(spark, database)
    assert not tables.database_exists(spark, database + "_x")
