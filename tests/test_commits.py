"""One commit per run: tables together or not at all, retries from the same state, parts, staging."""

import datetime as dt
import glob
import json
import os

import pytest

from pyspark.sql import functions as F

from staffline import jobs
from staffline.operators import timecards as TC
from staffline.schemas import conform
from staffline.session import cut_lineage
from staffline.sources import documents as DOC
from staffline.sources.commits import Conflict, Run, commits_of, state
from staffline.sources.sinks import read_runs, write_state
from tests.test_jobs import _pages, _worker


def ids(df):
    return sorted(r.id for r in df.collect())


def commit(spark, root, run_id, job, **tables):
    with Run(spark, root, run_id, job) as run:
        for table, ids_ in tables.items():
            run.write(spark.createDataFrame([(i,) for i in ids_], "id long"), table)
        run.commit()


def test_tables_become_visible_together(spark, tmp_path):
    root = str(tmp_path)
    commit(spark, root, "9", "a", departments=[1], locations=[1])
    with pytest.raises(RuntimeError, match="between"):
        with Run(spark, root, "10", "a") as run:
            run.write(spark.range(5), "departments")
            cut_lineage(spark.range(3))
            assert ids(run.read("departments")) == [0, 1, 2, 3, 4]
            assert ids(state(spark, root, "departments")) == [1]   # not yet committed
            raise RuntimeError("between two tables")
    assert ids(state(spark, root, "departments")) == [1]
    assert glob.glob(f"{root}/_staging/*") == [] and len(glob.glob(f"{root}/departments/run=*")) == 1
    commit(spark, root, "10", "a", departments=[2])
    assert ids(state(spark, root, "departments")) == [2] and ids(state(spark, root, "locations")) == [1]
    assert [key for _, key in commits_of(spark, root)] == ["9.a", "10.a"]   # in order of writing, not of ids


def test_a_retry_starts_where_the_run_did(spark, tmp_path):
    root = str(tmp_path)
    commit(spark, root, "1", "a", departments=[1])
    commit(spark, root, "2", "a", departments=[1, 2])
    commit(spark, root, "2", "b", locations=[7])
    for n in (3, 4):
        with Run(spark, root, "2", "a") as run:
            assert ids(run.read("departments")) == [1]
            run.write(spark.createDataFrame([(1,), (n,)], "id long"), "departments")
            run.commit()
        assert ids(state(spark, root, "departments")) == [1, n]
        assert ids(state(spark, root, "locations")) == [7]   # another run's table stays


def test_later_states_and_runs_at_once_conflict(spark, tmp_path):
    root = str(tmp_path)
    commit(spark, root, "1", "a", departments=[1])
    commit(spark, root, "2", "b", departments=[2])
    with pytest.raises(Conflict):
        Run(spark, root, "1", "a")           # its departments were built on
    one, two = Run(spark, root, "3", "a"), Run(spark, root, "3", "b")
    with one, two:
        one.write(spark.range(1), "departments")
        two.write(spark.range(2), "departments")
        one.commit()
        with pytest.raises(Conflict):
            two.commit()
    assert ids(state(spark, root, "departments")) == [0]
    with pytest.raises(ValueError):
        Run(spark, root, "../x", "a")


def test_states_of_all_runs_by_one_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    for run_id, row in (("007", "1L AS id"), ("a.b", "2L AS id, 'x' AS w")):
        write_state(spark.sql(f"SELECT {row}"), path, run_id)
    df = read_runs(spark, path)
    assert sorted((r.run, r.id, r.w) for r in df.collect()) == [("007", 1, None), ("a.b", 2, "x")]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_a_retried_worker_run_gives_the_same_hours(spark, tmp_path):
    """Ids change in a chain, 1 to 2 and 2 to 3; the run is made twice."""
    root = str(tmp_path)
    kept = spark.sparkContext.getCheckpointDir()
    before = sorted(glob.glob(f"{kept.removeprefix('file:')}/**", recursive=True))
    jobs.worker_run(spark, _pages(spark, _worker("G1", 1), _worker("G2", 2)), root, "1", dt.datetime(2024, 1, 1))
    with Run(spark, root, "h", "load") as run:
        hours = spark.sql("SELECT 5L AS id, 1L AS employee_id, DATE'2024-01-05' AS date UNION ALL SELECT 6, 2, DATE'2024-02-05'")
        run.write_parts(hours.withColumn("month", TC.month_of("date")), "employee_hours", "month", None)
        run.commit()
    for _ in range(2):
        jobs.worker_run(spark, _pages(spark, _worker("G1", 2), _worker("G2", 3)), root, "2", dt.datetime(2024, 2, 1))
        assert sorted((r.id, r.employee_id) for r in jobs.state(spark, root, "employee_hours").collect()) == [(5, 2), (6, 3)]
        assert ids(jobs.state(spark, root, "employees")) == [2, 3]
    assert sorted(glob.glob(f"{kept.removeprefix('file:')}/**", recursive=True)) == before   # nothing staged is left
    assert glob.glob(f"{root}/_staging/*") == []


def _cards(spark, *days):
    """One timecard document of (aoid, day, hours)."""
    cards = [{"associateOID": a, "timePeriod": {"startDate": d[:8] + "01"}, "dailyTotals": [
        {"entryDate": d, "timeDuration": f"PT{h}H", "payCode": {"codeValue": "REGULAR"}}]} for a, d, h in days]
    docs = spark.createDataFrame([(json.dumps({"timeCards": cards}),)], "doc string")
    return DOC.parse(docs, "doc", DOC.TIMECARD_SCHEMA)


def test_a_pull_writes_only_the_months_it_touches(spark, tmp_path):
    root = str(tmp_path)
    as_of = dt.datetime(2024, 5, 1)
    employees = spark.sql("SELECT 1L AS id, 'G1' AS aoid, 7L AS job_title_id, 'Active' AS status")
    history = "SELECT 1L AS id, 1L AS employee_id, 7L AS job_title_id, DATE'2020-01-01' AS start_date, {} AS end_date"
    with Run(spark, root, "1", "load") as run:
        run.write(conform(employees, "employees"), "employees")
        run.write(conform(spark.sql(history.format("CAST(NULL AS DATE)")), "employee_job_history"), "employee_job_history")
        run.commit()

    def pull(run_id, *days):
        jobs.timecard_run(spark, _cards(spark, *days), root, run_id, as_of)
        rows = jobs.state(spark, root, "employee_hours").collect()
        assert len({r.id for r in rows}) == len(rows)
        parts = {p.split("month=")[1]: os.path.basename(os.path.dirname(p)) for p in
                 jobs.state(spark, root, "employee_hours").select(
                     F.regexp_extract("_metadata.file_path", "(.*)/[^/]+$", 1).alias("p")).distinct().toPandas()["p"]}
        return {str(r.date): (r.work_minutes, r.job_title_id) for r in rows}, parts

    all_days = [("G1", f"2024-0{m}-10", 8) for m in (1, 2, 3)]
    rows, first = pull("1", *all_days)
    assert len(rows) == 3 and len(set(first.values())) == 1
    pull("2", *all_days)                                  # the months inserted last count as touched once more
    _, second = pull("3", ("G1", "2024-03-10", 8))
    rows, third = pull("4", ("G1", "2024-03-10", 5), ("G1", "2024-04-02", 4))
    assert rows["2024-03-10"][0] == 300 and rows["2024-04-02"][0] == 240 and len(rows) == 4
    assert third["2024-01"] == second["2024-01"] and third["2024-02"] == second["2024-02"]   # the same files
    assert third["2024-03"] != second["2024-03"]
    # A position that ends and another that begins change the titles of the months that they cover.
    with Run(spark, root, "5", "load") as run:
        two = spark.sql(history.format("DATE'2024-01-31'") + " UNION ALL SELECT 2, 1, 8, DATE'2024-02-01', NULL")
        run.write(conform(two, "employee_job_history"), "employee_job_history")
        run.commit()
    rows, _ = pull("6", ("G1", "2024-04-02", 4))
    assert [rows[d][1] for d in sorted(rows)] == [7, 8, 8, 8]


def test_months_of_changed_positions(spark):
    schema = "id long, employee_id long, job_title_id long, start_date date, end_date date"
    d = dt.date
    a = spark.createDataFrame([(1, 1, 7, d(2020, 1, 5), d(2024, 2, 1)), (2, 2, 7, d(2024, 1, 1), None)], schema)
    b = spark.createDataFrame([(1, 1, 7, d(2020, 1, 5), d(2024, 2, 1)), (2, 2, 8, d(2024, 3, 9), d(2024, 4, 1))], schema)
    got = sorted(r.month for r in TC.months_of_changed_positions(a, b, "2023-12", "2024-04").collect())
    assert got == ["2024-01", "2024-02", "2024-03", "2024-04"]
    assert TC.months_of_changed_positions(a, a, "2023-12", "2024-04").collect() == []
