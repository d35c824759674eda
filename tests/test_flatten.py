"""Worker extractor policies on hand-made documents."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from staffline.operators.flatten import flatten_workers
from staffline.sources.documents import WORKER_PAGE_SCHEMA, parse, worker_documents_from_tables

REQUIRED_PERSON = {"legalName": {"givenName": "Ann", "familyName1": "Lee"}, "birthDate": "1980-02-03",
                   "legalAddress": {"lineOne": "1 Main", "cityName": "Davis",
                                    "countrySubdivisionLevel1": {"codeValue": "CA"}, "postalCode": "95616-1234"}}


def _doc(**over):
    primary = {"primaryIndicator": True, "payrollFileNumber": "000042",
               "assignedOrganizationalUnits": [{}, {"nameCode": {"codeValue": "101", "longName": "101 - Nursing"}}],
               "reportsTo": [{"positionID": "S3600000017"}], "jobCode": {"codeValue": "7", "shortName": "RN"},
               "hireDate": "2020-01-02"}
    primary.update(over.pop("primary", {}))
    doc = {"associateOID": "G1", "workAssignments": [{"primaryIndicator": False, "payrollFileNumber": "9"}, primary],
           "person": dict(REQUIRED_PERSON)}
    doc.update(over)
    return doc


def _flat(spark, docs, mode="failfast"):
    text = spark.createDataFrame([(json.dumps({"workers": docs}),)], "doc string")
    parsed = text.select(F.from_json("doc", WORKER_PAGE_SCHEMA).alias("d")).select("d.*")
    return flatten_workers(parsed, mode=mode)


def test_sample_document(spark):
    r = _flat(spark, [_doc()]).first()
    assert (r.id, r.location_id, r.location, r.department, r.department_id) == (42, 0, "Unassigned", "Nursing", 101)
    assert (r.reports_to_id, r.job_title_id, r.job_title, r.zip_code) == (17, 7, "RN", "95616")
    assert r.legal_middle_name is None and r.work_email is None


def test_one_org_unit_defaults(spark):
    r = _flat(spark, [_doc(primary={"assignedOrganizationalUnits": [{}]})]).first()
    assert (r.department_id, r.department) == (0, "Unassigned")


def test_hire_sentinel_fallbacks(spark):
    base = {"primary": {"hireDate": "2023-10-01", "seniorityDate": "2011-05-06"}}
    r = _flat(spark, [_doc(**base, customFieldGroup={"dateFields": [{}, {}, {"dateValue": "2009-01-01"}]})]).first()
    assert str(r.ultimate_hire_date) == "2009-01-01"
    r = _flat(spark, [_doc(**base)]).first()
    assert str(r.ultimate_hire_date) == "2011-05-06"
    r = _flat(spark, [_doc(primary={"hireDate": "2023-10-01"}, workerDates={"originalHireDate": "2001-01-01"})]).first()
    assert str(r.ultimate_hire_date) == "2001-01-01"


def test_no_primary_assignment_fails_fast(spark):
    doc = _doc()
    doc["workAssignments"] = [doc["workAssignments"][0]]
    with pytest.raises(PySparkException):
        _flat(spark, [doc]).collect()


def test_quarantine_splits_bad_rows(spark):
    bad_payroll = _doc(primary={"payrollFileNumber": "X12"})
    no_city = _doc()
    no_city["person"] = {**REQUIRED_PERSON, "legalAddress": {**REQUIRED_PERSON["legalAddress"], "cityName": None}}
    good, bad = _flat(spark, [_doc(), bad_payroll, no_city], mode="quarantine")
    assert good.count() == 1
    errs = sorted(r.errors[0] for r in bad.collect())
    assert errs == ["city", "id"]


def _pages(spark, texts):
    return parse(spark.createDataFrame([(t,) for t in texts], "doc string"), "doc", WORKER_PAGE_SCHEMA)


def test_quarantine_of_lost_pages(spark):
    """A page cut off, one without a list, an empty one, and an entry that is null: only the first two are lost pages."""
    texts = [json.dumps({"workers": [_doc()]})[:50], "{}", json.dumps({"workers": []}),
             json.dumps({"workers": [None, _doc(), _doc(associateOID=None)]})]
    good, bad = flatten_workers(_pages(spark, texts), mode="quarantine")
    assert [r.aoid for r in good.collect()] == ["G1"]
    rows = sorted(bad.collect(), key=lambda r: r.errors)
    assert [r.errors[0] for r in rows] == ["aoid", "no primary assignment", "page does not parse", "page does not parse"]
    assert bad.columns == [*good.columns, "errors"]
    assert all(v is None for r in rows[2:] for v in r[:-1])
    # A null entry of a page that parses still gets the defaults.
    assert (rows[1].location_id, rows[1].location) == (0, "Unassigned")


def test_quarantine_makes_and_parses_a_page_once(spark):
    """The optimizer must not copy the text of a page into a filter for lost pages."""
    marked = spark.range(3).select(F.concat(F.lit('{"mark'), F.col("id").cast("string")).alias("doc"))
    marked = marked.withColumn("doc", F.when(F.col("doc") == "x", F.lit("y")).otherwise(F.col("doc")))
    bad = flatten_workers(parse(marked, "doc", WORKER_PAGE_SCHEMA), mode="quarantine")[1].select("aoid", "errors")
    plan = bad._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count('{"mark') == 1 and plan.count("from_json(") == 1
    assert [r.errors for r in bad.collect()] == [["page does not parse"]] * 3


def test_worker_documents_spread_over_tasks(spark):
    """Two keys of the title join, from one partition: documents are made by as many tasks as a shuffle has."""
    customer = spark.createDataFrame([(50 * i + i % 2, 1, 2.0, "S") for i in range(400)],
                                     "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(1)
    titles = spark.createDataFrame([(0, "B"), (0, "A"), (51, "C")], "job_title_id long, job_title string")
    docs = worker_documents_from_tables(customer, titles)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert docs.rdd.getNumPartitions() == n and docs.count() == 400
    assert docs.where(F.col("doc").contains('"longName":"A"')).count() == 200
    assert docs.where(F.col("doc").contains('"longName":"Title 1"')).count() == 200
