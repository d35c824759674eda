"""Hand-computed reconciliation cases and properties."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import Window

from staffline.operators import accounts as A
from staffline.operators import dedupe as D
from staffline.operators import history as HI
from staffline.operators.ordering import first_by
from staffline.operators.reconcile import anti_join, assign_ids, not_in

NOW = dt.datetime(2024, 5, 1, 8, 0)
T0 = dt.datetime(2020, 1, 1)
USERS = ("id int, guid string, primary_guid string, source string, first_name string, email string, "
         "created_at timestamp, is_disabled boolean, disabled_at timestamp, is_deleted boolean, "
         "deleted_at timestamp, is_primary_acct boolean, is_non_user boolean")
SNAP = "guid string, source string, first_name string, email string, created_at timestamp, is_disabled boolean"


def _users(spark):
    return spark.createDataFrame([
        (1, "a", "a", "server1", "Ann", None, T0, False, None, False, None, True, False),   # NULL -> value
        (2, "b", "b", "server1", "Bob", "b@x", T0, False, None, False, None, True, False),  # unchanged
        (3, "c", "c", "server2", "Cy", "c@x", T0, False, None, True, T0, True, False),      # deleted, returns
        (4, "d", "d", "server2", "Di", "d@x", T0, False, None, False, None, True, False),   # absent -> deleted
        (5, "e", "e", "server1", "Ed", "e@x", T0, False, None, False, None, True, False),   # turns disabled
    ], USERS)


def _snapshot(spark):
    return spark.createDataFrame([
        ("a", "server1", "Ann", "a@x", T0, False), ("b", "server1", "Bob", "b@x", T0, False),
        ("c", "server2", "Cy", "c@x", T0, False), ("e", "server1", "Ed", "e@x", T0, True),
        ("f", "server2", "Fay", "f@x", T0, True),  # new
    ], SNAP)


def test_account_run_hand_computed(spark):
    out = {r.guid: r for r in A.reconcile_accounts(_users(spark), _snapshot(spark), NOW).collect()}
    assert out["a"].email == "a@x"                      # NULL -> value applied (EXCEPT is NULL-safe)
    assert out["c"].is_deleted is False and out["c"].deleted_at is None
    assert out["d"].is_deleted is True and out["d"].deleted_at == NOW
    assert out["e"].is_disabled is True and out["e"].disabled_at == NOW
    assert out["f"].id == 6 and out["f"].primary_guid == "f" and out["f"].disabled_at == NOW
    b = out["b"]
    assert (b.id, b.email, b.is_deleted, b.is_disabled, b.disabled_at) == (2, "b@x", False, False, None)


def test_change_count_modes(spark):
    r = A.account_change_count(_users(spark), _snapshot(spark)).first()
    # NULL-unsafe misses guid a (NULL -> a@x); both see e (disabled).
    assert (r.changed_reference, r.changed) == (1, 2)


def test_second_run_is_idempotent(spark):
    once = A.reconcile_accounts(_users(spark), _snapshot(spark), NOW)
    twice = A.reconcile_accounts(once, _snapshot(spark), NOW)
    cols = [c for c in once.columns]
    assert sorted(map(tuple, once.select(cols).collect()), key=repr) == \
        sorted(map(tuple, twice.select(cols).collect()), key=repr)


def test_delete_and_undelete_exclusive(spark):
    users, snap = _users(spark), _snapshot(spark)
    deleted = {r.guid for r in A.soft_delete_accounts(users, snap, NOW).filter("is_deleted").collect()}
    undeleted = {r.guid for r in A.undelete_accounts(users, snap).collect() if r.is_deleted is False}
    was_deleted = {r.guid for r in users.filter("is_deleted").collect()}
    assert not ((undeleted & was_deleted) & (deleted - was_deleted))


def test_not_in_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right_null = spark.createDataFrame([(1,), (None,)], "k int")
    right = spark.createDataFrame([(1,)], "k int")
    assert not_in(left, right_null, "k").count() == 0                       # SQL: NULL empties NOT IN
    assert [r.k for r in not_in(left, right_null, "k", sql_null_semantics=False).collect()] == [2]
    assert [r.k for r in anti_join(left, right, "k").collect()] == [2]      # NULL left key dropped


def test_assign_ids_dense_in_key_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    out = assign_ids(df, ["k"], start_after=100, num_partitions=7).collect()
    assert sorted((r.k, r.id) for r in out) == [(k, 101 + k) for k in range(5000)]


def test_first_by_equals_row_number(spark):
    rows = [(i % 13, (i * 37) % 11, None if i % 5 == 0 else dt.datetime(2020, 1, 1 + i % 20), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, a int, ts timestamp, id int")
    order = [("a", "asc"), ("ts", "desc"), ("id", "asc")]
    got = {(r.g, r.id) for r in first_by(df, ["g"], order).collect()}
    w = Window.partitionBy("g").orderBy(F.col("a").asc_nulls_first(), F.col("ts").desc_nulls_last(), "id")
    want = {(r.g, r.id) for r in df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").collect()}
    assert got == want


def test_dedupe_hand_computed(spark):
    users = spark.createDataFrame([
        (1, "g1", "g1", "Ann", "x@organizationname.org", T0, False, False, True, False),
        (2, "g2", "g2", "Ann", "x@organizationname.org", dt.datetime(2021, 1, 1), False, False, True, False),
        (3, "g3", "g3", "Bo", "x@organizationname.org", T0, True, False, False, False),   # secondary, disabled
        (4, "g4", "g4", "Cy", "y@x", T0, False, False, True, True),                      # non-user
        (5, "g5", "g5", "Cy", "y@x", T0, False, False, True, False),
    ], "id int, guid string, primary_guid string, first_name string, email string, created_at timestamp, "
       "is_disabled boolean, is_deleted boolean, is_primary_acct boolean, is_non_user boolean")
    out = {r.id: r for r in D.resolve_duplicates(users, "email").collect()}
    assert out[2].is_primary_acct is True                     # latest created wins
    assert (out[1].is_primary_acct, out[1].primary_guid) == (False, "g2")
    assert (out[3].is_primary_acct, out[3].primary_guid) == (False, "g2")
    assert out[5].is_primary_acct is True                     # y@x has one real primary account


def test_history_run_leaves_one_open_row(spark):
    hist = spark.createDataFrame([
        (1, 10, 1, dt.date(2020, 1, 1), None, dt.datetime(2020, 1, 1)),
        (2, 10, 1, dt.date(2020, 1, 1), None, dt.datetime(2021, 1, 1)),  # realignment duplicate
    ], "id int, employee_id int, job_title_id int, start_date date, end_date date, inserted_at timestamp")
    emp = spark.createDataFrame([(10, 2, dt.date(2022, 3, 1), None)],
                                "id int, job_title_id int, start_date date, termination_date date")
    out = sorted(HI.update_history(hist, emp, NOW).collect(), key=lambda r: r.id)
    assert [r.id for r in out] == [2, 3]
    assert out[0].end_date == dt.date(2022, 2, 28) and out[1].end_date is None


def test_dedupe_case_insensitive_collation(spark):
    users = spark.createDataFrame([
        (1, "g1", "g1", "Ann Lee", T0, False, False, True, False),
        (2, "g2", "g2", "ANN LEE", dt.datetime(2021, 1, 1), False, False, True, False),
    ], "id int, guid string, primary_guid string, common_name string, created_at timestamp, "
       "is_disabled boolean, is_deleted boolean, is_primary_acct boolean, is_non_user boolean")
    binary = D.resolve_duplicates(users, "common_name").filter("is_primary_acct").count()
    lcase = D.resolve_duplicates(users, "common_name", collation="UTF8_LCASE").filter("is_primary_acct").count()
    assert (binary, lcase) == (2, 1)


def _rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def test_employee_and_hours_runs_idempotent(spark):
    from staffline.operators import employees as EM
    from staffline.operators import timecards as TC
    from staffline.plans.registry import StaffTables
    from staffline.plans.timecard_q import _daily
    from staffline.session import cut_lineage
    t = StaffTables(spark, "/root/testdata/sf0.001")
    args = (t["worker_staging"], t["employee_job_titles"], NOW)
    emp1, info1 = EM.upsert_employees(t["employees"], t["employee_info"], *args)
    emp1, info1 = cut_lineage(emp1), cut_lineage(info1)
    emp2, info2 = EM.upsert_employees(emp1, info1, *args)
    assert _rows(emp1) == _rows(emp2) and _rows(info1) == _rows(info2)

    # Hours: the run re-titles before it inserts (statement order of the
    # reference), so rows inserted by a run take the history title on the next
    # run; from then on the same input changes nothing.
    daily = cut_lineage(_daily(t))
    hist = t["employee_job_history"]
    h1 = cut_lineage(TC.upsert_hours(t["employee_hours"], daily, hist))
    h2 = cut_lineage(TC.upsert_hours(h1, daily, hist))
    h3 = TC.upsert_hours(h2, daily, hist)
    assert _rows(h2) == _rows(h3)
    changed = {(r[0], r[1]) for r in set(_rows(h1)) ^ set(_rows(h2))}
    assert changed  # only titles of rows inserted by the first run moved
    assert h1.count() == h2.count()


def test_guid_on_both_servers_is_inserted_once(spark):
    from staffline.operators import accounts as A
    snap = spark.sql("SELECT 'g1' AS guid, 'server1' AS source, TIMESTAMP'2020-01-01' AS created_at, false AS is_disabled "
                     "UNION ALL SELECT 'g1', 'server2', TIMESTAMP'2021-01-01', false")
    users = spark.createDataFrame([], "id int, guid string")
    out = A.reconcile_accounts(users, snap, dt.datetime(2024, 1, 1)).collect()
    assert [(r.id, r.guid, r.source) for r in out] == [(1, "g1", "server2")]


def test_null_keys_of_left_joins_are_spread(spark):
    from staffline.operators.reconcile import spread_nulls
    df = spark.range(1000).selectExpr("CASE WHEN id % 2 = 0 THEN id END AS k").repartition(4)
    keys = [r[0] for r in df.select(spread_nulls("k")).collect()]
    assert len(set(keys)) == 1000 and sum(k < 0 for k in keys) == 500
