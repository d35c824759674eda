"""Audits that read the map once: JSON ids of all instances, and all findings in one pass."""

import __spark_entry__ as E
from pyspark.sql import functions as F

from staffline.operators import audit as AU

SF = "/root/testdata/sf0.001"


def _scans(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("customer.parquet") or \
        df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def _map(spark, rows):
    return spark.createDataFrame(rows, "id long, network_id long, employee_id long, ecw_ids string")


def test_json_ids_of_listed_and_of_all_instances(spark):
    wm = _map(spark, [(1, 10, None, '{"ecw instance 1":["a","a"],"ecw instance 2":[],"other":["z"]}'),
                      (2, None, None, None), (3, 30, None, ""), (4, 40, None, '{"ecw instance 2":["b"]}')])
    got = sorted(tuple(r) for r in AU.json_ids(wm).collect())
    assert got == [(1, 10, "ecw instance 1", "a"), (1, 10, "ecw instance 1", "a"), (4, 40, "ecw instance 2", "b")]
    every = {(r.id, r.source, r.ecw_id) for r in AU.json_ids(wm, None).collect()}
    assert every == {(1, "ecw instance 1", "a"), (1, "other", "z"), (4, "ecw instance 2", "b")}


def test_json_column_is_read_once(spark):
    for key in ("json_ids", "aud_dup_json"):
        assert _scans(E.queries()[key](spark, SF)) == 1, key


def test_audit_all_finds_each_kind_once(spark):
    wm = _map(spark, [(1, 7, 1, None), (2, 7, 2, None), (3, None, 9, None), (4, None, 9, None), (5, 8, None, None)])
    employees = spark.createDataFrame([(1, True, True), (2, True, False), (3, True, True), (4, True, False), (None, True, True)],
                                      "id long, exists boolean, expected boolean")
    got = {(r.finding, r.kind, r.key): r.people for r in AU.audit_all(wm, {"employee": employees}).collect()}
    assert got == {("unmapped", "employee", "3"): 0, ("orphan", "employee", "9"): 2, ("duplicate", "employee", "9"): 2,
                   ("duplicate", "network", "7"): 2, ("duplicate", "network", None): 2}
    assert AU.audit_all(wm.limit(0), {"employee": employees.limit(0)}).collect() == []


def test_audit_all_holds_the_single_audits(spark):
    q = E.queries()
    found = q["audit_all"](spark, SF).cache()
    for finding, kind, key in (("unmapped", "employee", "aud_unmapped_employee"), ("orphan", "learner", "aud_orphan_learner"),
                               ("unmapped", "epic", "aud_unmapped_ehr"), ("orphan", "epic", "aud_orphan_ehr"),
                               ("duplicate", "relevant", "aud_dup_relevant")):
        single = q[key](spark, SF)
        want = sorted(r[0] for r in single.select(F.col(single.columns[0]).cast("string")).collect())
        mine = found.filter((F.col("finding") == finding) & (F.col("kind") == kind))
        assert sorted(r.key for r in mine.collect()) == want, key
    found.unpersist()


def test_audit_all_explodes_the_map_once_and_joins_nothing(spark):
    """The only joins are those of the EHR providers with their encounters (a semi join)."""
    plan = E.queries()["audit_all"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Generate explode" in line and "network_id" in line for line in plan.splitlines()) == 1
    assert all("LeftSemi" in line for line in plan.splitlines() if " Join " in line or "Join Left" in line)
