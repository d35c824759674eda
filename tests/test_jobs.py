"""The four runs end to end on documents derived from the sf0.001 tables."""

import datetime as dt
import json
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from staffline import jobs
from staffline.operators import audit as AU
from staffline.plans.registry import StaffTables
from staffline.sources import documents as DOC

SF = "/root/testdata/sf0.001"


def test_four_runs(spark):
    t = StaffTables(spark, SF)
    root = os.path.join(tempfile.mkdtemp(prefix="staffline-jobs-"), "tables")
    as_of = dt.datetime(2000, 7, 15, 10, 30)
    pages = DOC.parse(DOC.worker_documents_from_tables(t["customer"], t["employee_job_titles"]), "doc",
                      DOC.WORKER_PAGE_SCHEMA)
    jobs.worker_run(spark, pages, root, "r1", as_of, initial={"employee_job_titles": t["employee_job_titles"],
                                                              "departments": t["departments"],
                                                              "locations": t["locations"]})
    employees = jobs.state(spark, root, "employees")
    assert employees.count() == t["customer"].count()
    assert jobs.state(spark, root, "employee_job_history").count() == employees.count()  # one open row each

    cards = DOC.parse(DOC.timecard_documents_from_tables(t["lineitem"], t["orders"]), "doc", DOC.TIMECARD_SCHEMA)
    jobs.timecard_run(spark, cards, root, "r1", as_of)
    hours = jobs.state(spark, root, "employee_hours")
    assert hours.count() > 0
    assert hours.groupBy("employee_id", "date").count().filter("count > 1").count() == 0  # PK holds
    assert hours.select("id").distinct().count() == hours.count()

    jobs.directory_run(spark, DOC.directory_entries_from_tables(t["customer"]), root, "r1", as_of)
    users = jobs.state(spark, root, "network_users")
    assert users.count() == t["customer"].count()
    first = sorted(map(tuple, users.collect()), key=repr)
    # A retried run (same id) starts from the state before it and replaces its own output.
    jobs.directory_run(spark, DOC.directory_entries_from_tables(t["customer"]), root, "r1", as_of)
    again = jobs.state(spark, root, "network_users")
    assert sorted(map(tuple, again.collect()), key=repr) == first

    jobs.linkage_run(spark, root, "r1", t["analytics_users"], t["ehr_users"])
    wm = jobs.state(spark, root, "workforce_map")
    assert wm.filter(F.col("employee_id").isNotNull()).count() > 0
    assert AU.duplicate_ids(wm, "employee_id").count() == 0
    assert AU.duplicate_ids(wm, "network_id").count() == 0

    from staffline.sources.sinks import read_runs
    log = read_runs(spark, os.path.join(root, "run_log"))
    assert sorted(r.query_type for r in log.collect()) == ["directory", "timecards", "workers"]
    assert log.filter("query_type = 'timecards'").first().warnings == "Unmapped paycodes: ZZZ"


def _worker(aoid, number, title="T", title_id="7"):
    return {"associateOID": aoid, "person": {"legalName": {"givenName": "A", "familyName1": "B"}, "birthDate": "1980-01-01",
            "legalAddress": {"lineOne": "1 St", "cityName": "C", "countrySubdivisionLevel1": {"codeValue": "CA"},
                             "postalCode": "95616"}},
            "workAssignments": [{"primaryIndicator": True, "payrollFileNumber": str(number), "hireDate": "2020-01-02",
                                 "actualStartDate": "2020-01-02", "jobCode": {"codeValue": title_id, "longName": title}}]}


def _pages(spark, *workers):
    docs = spark.createDataFrame([(json.dumps({"workers": list(workers)}),)], "doc string")
    return DOC.parse(docs, "doc", DOC.WORKER_PAGE_SCHEMA)


def test_changed_id_takes_its_rows_along(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="staffline-rekey-"), "tables")
    first, second = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    jobs.worker_run(spark, _pages(spark, _worker("G1", 1), _worker("G2", 2), _worker("G2", 2)), root, "1", first)
    assert sorted(r.id for r in jobs.state(spark, root, "employees").collect()) == [1, 2]  # a worker listed twice
    assert sorted(r.id for r in jobs.state(spark, root, "employee_info").collect()) == [1, 2]
    from staffline.sources.sinks import write_state
    write_state(spark.sql("SELECT 5L AS id, 1 AS employee_id, 7 AS job_title_id, DATE'2024-01-05' AS date"),
                f"{root}/employee_hours", "1")
    write_state(spark.sql("SELECT 9 AS id, 1 AS employee_id UNION ALL SELECT 10, NULL"), f"{root}/workforce_map", "1")
    jobs.worker_run(spark, _pages(spark, _worker("G1", 901), _worker("G2", 2)), root, "2", second)
    history = jobs.state(spark, root, "employee_job_history").collect()
    assert sorted(r.employee_id for r in history) == [2, 901]
    assert [r.employee_id for r in jobs.state(spark, root, "employee_hours").collect()] == [901]
    assert {r.id: r.employee_id for r in jobs.state(spark, root, "workforce_map").collect()} == {9: 901, 10: None}
    assert sorted(r.id for r in jobs.state(spark, root, "employee_info").collect()) == [2, 901]


def test_failed_run_leaves_a_log_row(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="staffline-failed-"), "tables")
    bad = spark.createDataFrame([('{"workers": [',)], "doc string")
    with pytest.raises(Exception, match="does not parse"):
        jobs.worker_run(spark, DOC.parse(bad, "doc", DOC.WORKER_PAGE_SCHEMA), root, "1", dt.datetime(2024, 1, 1))
    from staffline.sources.sinks import read_runs
    row = read_runs(spark, f"{root}/run_log").first()
    assert (row.query_type, row.is_success, row.failure_step) == ("workers", False, "flatten workers")
    assert jobs.state(spark, root, "employees").count() == 0
