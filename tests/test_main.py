import os
import subprocess
import sys
from datetime import date

import pytest
from shop import frames

import daybook.__main__ as cli
from daybook import session
from daybook.plans import jobs
from daybook.sources.readers import FrameReader


def test_arguments():
    args = cli.parse(
        ["run", "--database", "shop", "--run-date", "2021-03-02", "--rebase-anchor", "2021-03-01"]
    )
    assert (args.command, args.database, args.lag_days) == ("run", "shop", 1)
    assert args.run_date == date(2021, 3, 2) and args.rebase_anchor == date(2021, 3, 1)
    with pytest.raises(SystemExit):
        cli.parse(["run"])


def test_source_options(tmp_path):
    file = tmp_path / "source.properties"
    file.write_text("# source\nurl = jdbc:mysql://h/db?a=b\n\nuser=reader\n")
    assert cli.source_options(file) == {"url": "jdbc:mysql://h/db?a=b", "user": "reader"}


def test_reports_from_the_command_line(spark, database, monkeypatch, capsys):
    monkeypatch.setattr(cli, "apply_cluster_settings", lambda spark: None)
    monkeypatch.setattr(cli, "session", lambda: spark)
    monkeypatch.setattr(cli, "require_persistent_catalog", lambda spark: None)
    model = frames(spark)
    source = FrameReader({**model, "orders": model["orders"].drop("dt")})
    jobs.run_daily(spark, jobs.JobConfig(database, source), date(2021, 3, 2))
    cli.main(["reports", "--database", database, "--run-date", "2021-03-02"])
    assert "department_sales: 2 rows" in capsys.readouterr().out


def test_a_catalog_in_memory_is_refused(spark, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    monkeypatch.setattr(cli, "apply_cluster_settings", lambda spark: None)
    with pytest.raises(ValueError, match="in memory"):
        cli.main(["run", "--database", "shop", "--run-date", "2021-03-02"])


PROCESS = """
import sys
sys.path[:0] = sys.argv[1:3]
from datetime import date
import daybook.__main__ as cli
from shop import frames
from daybook.plans import jobs
from daybook.sources.readers import FrameReader

cli.JdbcReader = lambda spark, options: FrameReader(
    {**(model := frames(spark)), "orders": model["orders"].drop("dt")}
)
cli.source_options = lambda path: {}
cli.main(sys.argv[3:])
spark = cli.session()
print("TABLE", sorted(map(tuple, spark.table("shop.department_wise_sales").collect())))
"""


def test_runs_in_several_processes_share_a_warehouse(tmp_path):
    """A first run, a daily run and reports alone, each in a process of its own."""
    (tmp_path / "conf").mkdir()
    (tmp_path / "conf" / "spark-defaults.conf").write_text(
        f"spark.sql.warehouse.dir {tmp_path}/warehouse\n"
        f"spark.hadoop.javax.jdo.option.ConnectionURL jdbc:derby:;databaseName={tmp_path}/metastore;create=true\n"
        f"spark.checkpoint.dir {tmp_path}/shared\n"
        "spark.master local[2]\nspark.ui.enabled false\nspark.sql.shuffle.partitions 2\n"
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum 2\n"
    )
    tests = os.path.dirname(os.path.abspath(__file__))
    source = ["--source", "none"]
    outputs = []
    for command, more in (("run", source), ("run", source), ("reports", [])):
        done = subprocess.run(
            [sys.executable, "-c", PROCESS, os.path.dirname(tests), tests, command,
             "--database", "shop", "--run-date", "2021-03-02", *more],
            env=os.environ | {"SPARK_CONF_DIR": f"{tmp_path}/conf"}, cwd=tmp_path,
            capture_output=True, text=True, timeout=300,
        )
        assert done.returncode == 0, done.stderr[-3000:]
        outputs.append(done.stdout)
    tables = {line for out in outputs for line in out.splitlines() if line.startswith("TABLE")}
    assert len(tables) == 1 and all("department_sales: 2 rows" in out for out in outputs)


def test_settings_of_the_submitted_job_win(spark, conf):
    for key, value in session.CLUSTER_SETTINGS.items():
        conf(key, value)  # restored after the test
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    session.apply_cluster_settings(spark)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10m"
    assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"  # given at start


def test_steps_all_end_before_a_failure_is_raised(spark):
    ended = []

    def fails():
        raise RuntimeError("step failed")

    with pytest.raises(RuntimeError, match="step failed"):
        jobs._together(spark, [("a", fails), ("b", lambda: ended.append("b"))], at_once=1)
    assert ended == ["b"]
