"""A state that breaks a key, a NOT NULL column or a reference is never committed."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from staffline.schemas import TABLES
from staffline.sources.commits import Run, commits_of, state
from staffline.sources.constraints import KEYS, REFERENCES, REQUIRED, BrokenConstraint, broken_rows

EMP = "id long, aoid string, location_id long, department_id long, job_title_id long, legal_first_name string, legal_last_name string"
HOURS = "id long, employee_id long, job_title_id long, date date, work_minutes long, paid_minutes long, regular_minutes long"
DAY = dt.date(2024, 1, 31)


def employee(id_, location=1, aoid="G"):
    return (id_, aoid, location, 1, 1, "Ada", "Byron")


def run(spark, root, run_id, employees=None, hours=None, months=None, constraints=True):
    with Run(spark, root, run_id, "t", constraints) as r:
        if run_id == "1":
            r.write(spark.createDataFrame([(1, "Main")], "id long, location string"), "locations")
            r.write(spark.createDataFrame([(1, "Care")], "id long, name string"), "departments")
            r.write(spark.createDataFrame([(1, 7, "Nurse")], "id long, job_title_id long, job_title string"), "employee_job_titles")
        if employees is not None:
            r.write(spark.createDataFrame(employees, EMP), "employees")
        if hours is not None:
            rows = spark.createDataFrame(hours, HOURS).withColumn("month", F.date_format("date", "yyyy-MM"))
            r.write_parts(rows, "employee_hours", "month", months)
        r.commit()


def test_declared_columns_exist():
    for table, cols in [*KEYS.items(), *REQUIRED.items(), *REFERENCES.items()]:
        assert set(cols) <= set(TABLES[table].fieldNames()), table
    assert {p for refs in REFERENCES.values() for p in refs.values()} <= set(KEYS)


@pytest.mark.parametrize("employees, why", [
    ([employee(1), employee(1)], r"employees: 1 rows repeat the key \(id\)"),
    ([employee(1), employee(2, aoid=None)], "employees: 1 rows without aoid"),
    ([employee(None), employee(None)], "employees: 2 rows without id"),
    ([employee(1, location=9), employee(2, location=9)], "employees: 2 rows whose location_id is not in locations"),
])
def test_each_kind(spark, tmp_path, employees, why):
    root = str(tmp_path)
    run(spark, root, "1", [employee(1), employee(2)])
    with pytest.raises(BrokenConstraint, match=why):
        run(spark, root, "2", employees)
    assert len(commits_of(spark, root)) == 1 and state(spark, root, "employees").count() == 2
    run(spark, root, "2", employees, constraints=False)
    assert len(commits_of(spark, root)) == 2


def test_parts_and_ids_taken_out(spark, tmp_path):
    root = str(tmp_path)
    day = (1, 1, 1, DAY, 5, 5, 5)
    run(spark, root, "1", [employee(1), employee(2)], [day, (2, 2, 1, DAY, 5, 5, 5)])
    with pytest.raises(BrokenConstraint, match=r"repeat the key \(employee_id, date\)"):
        run(spark, root, "2", hours=[day, day], months={"2024-01"})
    with pytest.raises(BrokenConstraint, match="employee_hours: 1 rows whose employee_id is not in employees"):
        run(spark, root, "2", hours=[(3, 9, 1, dt.date(2024, 2, 1), 5, 5, 5)], months={"2024-02"})
    with pytest.raises(BrokenConstraint, match="employee_hours: 1 rows whose employee_id is no longer in employees"):
        run(spark, root, "2", [employee(1)])
    # In one run the parts that it does not write count too.
    with pytest.raises(BrokenConstraint, match="no longer in employees"):
        run(spark, root, "2", [employee(1)], [(3, 1, 1, dt.date(2024, 2, 1), 5, 5, 5)], {"2024-02"})
    run(spark, root, "2", [employee(1)], [day], {"2024-01"})
    assert state(spark, root, "employee_hours").count() == 1


def test_what_was_broken_before(spark, tmp_path):
    """A run that only carries broken rows along goes through; one more of them ends it."""
    root = str(tmp_path)
    bad = [employee(1, aoid=None), employee(2, location=9)]
    run(spark, root, "1", bad, constraints=False)
    run(spark, root, "2", [*bad, employee(3)])
    for more, why in [(employee(4, aoid=None), r"2 rows without aoid \(1 before\)"),
                      (employee(4, location=9), r"2 rows whose location_id is not in locations \(1 before\)")]:
        with pytest.raises(BrokenConstraint, match=why):
            run(spark, root, "3", [*bad, employee(3), more])
    assert state(spark, root, "employees").count() == 3


def test_empty_frames_and_columns_that_lack(spark):
    assert broken_rows(spark.createDataFrame([], EMP), "employees") == {}
    assert broken_rows(spark.range(2).withColumnRenamed("id", "other"), "employees") == {}
    assert broken_rows(spark.range(3), "not_declared") == {}
    # a key column that lacks: the other columns are still checked
    assert broken_rows(spark.createDataFrame([(DAY, None)], "date date, work_minutes long"), "employee_hours") == {
        "rows without work_minutes": 1}
