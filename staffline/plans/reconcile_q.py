"""Query keys of the reconciliation operators and their oracles.

Each key returns the new state of one stored table (or a one-row count).
Oracles are written the way the reference's statements read, as DuckDB SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import Window

from staffline.operators import accounts as A
from staffline.operators import employees as E
from staffline.operators import history as HI
from staffline.operators.reconcile import assign_ids
from staffline.operators.runlog import run_log_row
from staffline.plans.registry import query
from staffline.schemas import TABLES, sql_default
from staffline.schemas import conform
from staffline.session import cut_lineage

AS_OF = dt.datetime(2000, 7, 15, 10, 30, 0)
TS = "TIMESTAMP '2000-07-15 10:30:00'"

# Columns each fixture provides (the rest take DDL defaults / NULL).
FX_COLS = {
    "fx_employees": ["id", "aoid", "location_id", "department_id", "reports_to_id", "job_title_id",
                     "legal_first_name", "legal_middle_name", "legal_last_name", "work_email", "status",
                     "hire_date", "termination_date", "is_manager"],
    "fx_network_users": ["id", "guid", "primary_guid", "source", "first_name", "last_name", "common_name",
                         "display_name", "network_email", "primary_email", "email", "job_title", "created_at",
                         "is_disabled", "is_deleted",
                         "is_primary_acct", "is_non_user"],
    "fx_network_snapshot": ["guid", "source", "first_name", "last_name", "common_name", "display_name",
                            "network_email", "primary_email", "email", "job_title", "created_at", "is_disabled"],
    "fx_job_titles": ["id", "job_title_id", "job_title", "uds_line", "hcai_line", "has_clinical_admin_time"],
    "fx_workforce_map": ["id", "network_id", "employee_id", "contractor_id", "learner_id", "volunteer_id",
                         "relevant_id", "analytics_id", "epic_id", "ecw_ids"],
}


def cols(table: str) -> list[str]:
    return TABLES[table].fieldNames()


def col_sql(fx: str, table: str, c: str, alias: str) -> str:
    """Column ``c`` of fixture ``fx`` viewed as stored table ``table``."""
    return f"{alias}.{c}" if c in FX_COLS[fx] else sql_default(table, c)


def conformed_sql(fx: str, table: str, alias: str = "x") -> str:
    return ", ".join(f"{col_sql(fx, table, c, alias)} AS {c}" for c in cols(table))


# ----------------------------------------------------------------- dimensions
@query("dim_departments", """
SELECT id, name FROM fx_departments
UNION ALL
SELECT department_id AS id, MIN(department) AS name FROM fx_worker_staging
WHERE department_id IS NOT NULL AND department_id NOT IN (SELECT id FROM fx_departments)
GROUP BY department_id
""")
def q_dim_departments(t):
    """DML-1: departments seen for the first time."""
    return E.new_departments(t["worker_staging"], t["departments"])


@query("dim_locations", """
SELECT id, location, CAST(NULL AS VARCHAR) AS epic_location_id, epic_location, CAST(NULL AS VARCHAR) AS county
FROM fx_locations
UNION ALL
SELECT location_id, MIN(location), NULL, NULL, NULL FROM fx_worker_staging
WHERE location_id IS NOT NULL AND location_id NOT IN (SELECT id FROM fx_locations)
GROUP BY location_id
""")
def q_dim_locations(t):
    """DML-2: locations seen for the first time."""
    return E.new_locations(t["worker_staging"], t["locations"])


@query("dim_job_titles", f"""
WITH new AS (SELECT job_title_id, job_title FROM fx_worker_staging
             WHERE job_title_id IS NOT NULL AND job_title IS NOT NULL
             EXCEPT SELECT job_title_id, job_title FROM fx_job_titles)
SELECT {conformed_sql('fx_job_titles', 'employee_job_titles')} FROM fx_job_titles x
UNION ALL
SELECT CAST((SELECT MAX(id) FROM fx_job_titles) + ROW_NUMBER() OVER (ORDER BY job_title_id, job_title) AS BIGINT),
       job_title_id, job_title, NULL, NULL, NULL, {TS} FROM new
""")
def q_dim_job_titles(t):
    """DML-3: new (job_title_id, job_title) pairs with the next surrogate ids."""
    return E.new_job_titles(t["worker_staging"], t["employee_job_titles"], AS_OF)


# ------------------------------------------------------------------ employees
_S_TITLED = """SELECT w.*, jt.id AS title_sk FROM fx_worker_staging w
  JOIN fx_job_titles jt ON w.job_title_id = jt.job_title_id AND w.job_title = jt.job_title
  QUALIFY ROW_NUMBER() OVER (PARTITION BY w.aoid ORDER BY w.id, jt.id) = 1"""


def _emp_update_sql() -> str:
    out = []
    for c in cols("employees"):
        cur = col_sql("fx_employees", "employees", c, "e")
        if c in E.EMPLOYEE_SET:
            out.append(f"CASE WHEN s.aoid IS NOT NULL THEN s.{c} ELSE {cur} END AS {c}")
        elif c == "job_title_id":
            out.append(f"CASE WHEN s.aoid IS NOT NULL THEN s.title_sk ELSE {cur} END AS {c}")
        else:
            out.append(f"{cur} AS {c}")
    return f"SELECT {', '.join(out)} FROM fx_employees e LEFT JOIN ({_S_TITLED}) s ON e.aoid = s.aoid"


def _diff_pred(pairs, safe: bool) -> str:
    op = "IS DISTINCT FROM" if safe else "!="
    return " OR ".join(f"({a} {op} {b})" for a, b in pairs)


def _emp_count_sql() -> str:
    pairs = [(f"w.{c}", col_sql("fx_employees", "employees", c, "e")) for c in E.EMPLOYEE_SET]
    pairs.append(("jt.id", "e.job_title_id"))
    pairs += [(f"w.{c}", f"i.{c}") for c in E.INFO_SET[1:]]
    return f"""
SELECT COUNT(CASE WHEN {_diff_pred(pairs, False)} THEN 1 END) AS changed_reference,
       COUNT(CASE WHEN {_diff_pred(pairs, True)} THEN 1 END) AS changed
FROM fx_worker_staging w JOIN fx_employees e ON w.aoid = e.aoid JOIN fx_employee_info i ON w.aoid = i.aoid
  JOIN fx_job_titles jt ON w.job_title_id = jt.job_title_id AND w.job_title = jt.job_title"""


@query("emp_change_count", _emp_count_sql())
def q_emp_change_count(t):
    """DML-4: matched employees with a change (NULL-unsafe and NULL-safe counts)."""
    return E.employee_change_count(t["worker_staging"], t["employees"], t["employee_info"], t["employee_job_titles"])


@query("emp_update", _emp_update_sql())
def q_emp_update(t):
    """DML-5: employees overwritten from the snapshot (24 columns incl. id)."""
    return E.update_employees(t["employees"], t["worker_staging"], t["employee_job_titles"])


_INFO_UPSERT_SQL = ("WITH s AS (SELECT * FROM fx_worker_staging QUALIFY ROW_NUMBER() OVER (PARTITION BY aoid ORDER BY id) = 1) "
                    "SELECT " + ", ".join(
                        "i.aoid AS aoid" if c == "aoid" else f"CASE WHEN s.aoid IS NOT NULL THEN s.{c} ELSE i.{c} END AS {c}"
                        for c in cols("employee_info"))
                    + " FROM fx_employee_info i LEFT JOIN s ON i.aoid = s.aoid UNION ALL SELECT "
                    + ", ".join(cols("employee_info"))
                    + " FROM fx_worker_staging WHERE aoid NOT IN (SELECT aoid FROM fx_employee_info)")


@query("emp_info_upsert", _INFO_UPSERT_SQL)
def q_emp_info_upsert(t):
    """DML-6 + DML-8: employee_info updated and new aoids inserted."""
    return E.upsert_employee_info(t["employee_info"], t["worker_staging"])


def _emp_insert_sql() -> str:
    new_cols = []
    for c in cols("employees"):
        if c == "job_title_id":
            new_cols.append("s.title_sk")
        elif c == "inserted_at":
            new_cols.append(TS)
        elif c == "is_deleted":
            new_cols.append("FALSE")
        elif c == "deleted_at":
            new_cols.append("CAST(NULL AS TIMESTAMP)")
        else:
            new_cols.append(f"s.{c}")
    return (f"SELECT {conformed_sql('fx_employees', 'employees', 'e')} FROM fx_employees e UNION ALL "
            f"SELECT {', '.join(new_cols)} FROM ("
            "SELECT w.*, jt.id AS title_sk FROM fx_worker_staging w JOIN fx_job_titles jt "
            "ON w.job_title_id = jt.job_title_id AND w.job_title = jt.job_title) s "
            "WHERE s.aoid NOT IN (SELECT aoid FROM fx_employees)")


@query("emp_insert", _emp_insert_sql())
def q_emp_insert(t):
    """DML-7: new workers (known title, new aoid) appended to employees."""
    return E.insert_employees(t["employees"], t["worker_staging"], t["employee_job_titles"], AS_OF)


def _soft_delete_sql(fx: str, table: str, key: str, present: str) -> str:
    out = []
    for c in cols(table):
        cur = col_sql(fx, table, c, "x")
        gone = f"(x.{key} NOT IN (SELECT {key} FROM {present} WHERE {key} IS NOT NULL) AND {col_sql(fx, table, 'is_deleted', 'x')} = FALSE)"
        if c == "is_deleted":
            out.append(f"CASE WHEN {gone} THEN TRUE ELSE {cur} END AS {c}")
        elif c == "deleted_at":
            out.append(f"CASE WHEN {gone} THEN {TS} ELSE {cur} END AS {c}")
        else:
            out.append(f"{cur} AS {c}")
    return f"SELECT {', '.join(out)} FROM {fx} x"


@query("emp_soft_delete", _soft_delete_sql("fx_employees", "employees", "aoid", "fx_worker_staging"))
def q_emp_soft_delete(t):
    """DML-9: employees absent from the snapshot are flagged deleted."""
    return E.soft_delete_employees(t["employees"], t["worker_staging"], AS_OF)


@query("emp_key_cascade", f"""
WITH s AS ({_S_TITLED}),
ch AS (SELECT e.id AS old_id, s.id AS new_id FROM fx_employees e JOIN s ON e.aoid = s.aoid WHERE e.id IS DISTINCT FROM s.id)
SELECT h.id, COALESCE(ch.new_id, h.employee_id) AS employee_id, h.job_title_id, h.start_date, h.end_date, h.inserted_at
FROM fx_job_history h LEFT JOIN ch ON h.employee_id = ch.old_id
""")
def q_emp_key_cascade(t):
    """DML-5b: job history re-keyed where the update changed employee ids."""
    return _rekeyed_history(t)


@query("new_employee_count", """
SELECT COUNT(*) AS new_employees FROM (SELECT aoid FROM fx_worker_staging EXCEPT SELECT aoid FROM fx_employees)
""")
def q_new_employee_count(t):
    """DML-7 count: ``aoid`` EXCEPT (can exceed the inserts, which need a title)."""
    return E.new_employee_count(t["employees"], t["worker_staging"])


# -------------------------------------------------------------------- history
_HIST = "id, employee_id, job_title_id, start_date, end_date, inserted_at"


# The history after employee ids changed (ON UPDATE CASCADE), as the run has it before new positions are added.
_REKEYED = f"""s AS ({_S_TITLED}),
ch AS (SELECT e.id AS old_id, s.id AS new_id FROM fx_employees e JOIN s ON e.aoid = s.aoid WHERE e.id IS DISTINCT FROM s.id),
jh AS (SELECT h.id, COALESCE(ch.new_id, h.employee_id) AS employee_id, h.job_title_id, h.start_date, h.end_date, h.inserted_at
       FROM fx_job_history h LEFT JOIN ch ON h.employee_id = ch.old_id)"""


def _rekeyed_history(t):
    changes = E.employee_id_changes(t["employees"], t["worker_staging"], t["employee_job_titles"])
    return E.cascade_employee_ids({"employee_job_history": t["employee_job_history"]}, changes)["employee_job_history"]


@query("hist_insert", f"""
WITH {_REKEYED},
emp AS ({_emp_update_sql()}),
new AS (SELECT id AS employee_id, job_title_id, start_date FROM emp
        WHERE id IS NOT NULL AND job_title_id IS NOT NULL AND start_date IS NOT NULL
        EXCEPT SELECT employee_id, job_title_id, start_date FROM jh)
SELECT {_HIST} FROM jh
UNION ALL
SELECT CAST((SELECT MAX(id) FROM fx_job_history) + ROW_NUMBER() OVER (ORDER BY start_date, employee_id, job_title_id) AS BIGINT),
       employee_id, job_title_id, start_date, CAST(NULL AS DATE), {TS} FROM new
""")
def q_hist_insert(t):
    """DML-10: new positions of the updated employees appended to the history."""
    emp = E.update_employees(t["employees"], t["worker_staging"], t["employee_job_titles"])
    return HI.insert_positions(_rekeyed_history(t), emp, AS_OF)


@query("hist_terminate", """
WITH last AS (SELECT employee_id, MAX(inserted_at) AS m FROM fx_job_history GROUP BY employee_id)
SELECT h.id, h.employee_id, h.job_title_id, h.start_date,
  CASE WHEN h.inserted_at = last.m AND e.termination_date IS NOT NULL AND h.end_date IS NULL
       THEN e.termination_date ELSE h.end_date END AS end_date, h.inserted_at
FROM fx_job_history h LEFT JOIN last ON h.employee_id = last.employee_id LEFT JOIN fx_employees e ON h.employee_id = e.id
""")
def q_hist_terminate(t):
    """DML-11a: the last position of a terminated employee ends at termination."""
    return HI.close_terminated(t["employee_job_history"], t["employees"])


@query("hist_position_end", """
WITH r AS (SELECT id, employee_id, start_date,
             ROW_NUMBER() OVER (PARTITION BY employee_id ORDER BY inserted_at DESC, id DESC) AS rn FROM fx_job_history),
upd AS (SELECT p.id, c.start_date - 1 AS e FROM r p JOIN r c ON p.employee_id = c.employee_id
        WHERE p.rn = 2 AND c.rn = 1 AND p.start_date < c.start_date - 1)
SELECT h.id, h.employee_id, h.job_title_id, h.start_date,
  CASE WHEN upd.id IS NOT NULL THEN upd.e ELSE h.end_date END AS end_date, h.inserted_at
FROM fx_job_history h LEFT JOIN upd ON h.id = upd.id
""")
def q_hist_position_end(t):
    """DML-11b: the previous position ends the day before the latest starts."""
    return HI.close_previous(t["employee_job_history"])


@query("job_realign", f"""
SELECT {_HIST} FROM fx_job_history
QUALIFY ROW_NUMBER() OVER (PARTITION BY employee_id, start_date ORDER BY inserted_at DESC, id DESC) = 1
""")
def q_job_realign(t):
    """DML-11c / WIN-4: only the latest row per (employee, start date) stays."""
    return HI.drop_realignments(t["employee_job_history"])


@query("job_rank", """
SELECT id, employee_id, start_date, rn FROM (
  SELECT id, employee_id, start_date, ROW_NUMBER() OVER (PARTITION BY employee_id ORDER BY inserted_at DESC, id DESC) AS rn
  FROM fx_job_history) WHERE rn <= 2
""")
def q_job_rank(t):
    """WIN-3: the two latest positions per employee (partial WindowGroupLimit)."""
    w = Window.partitionBy("employee_id").orderBy(F.col("inserted_at").desc(), F.col("id").desc())
    return (t["employee_job_history"].select("id", "employee_id", "start_date", F.row_number().over(w).cast("long").alias("rn"))
            .filter(F.col("rn") <= 2))


@query("hist_update", None)
def q_hist_update(t):
    """DML-10..11c chained: one full history run on the updated employees
    (the employees table is written first, as the reference commits it)."""
    emp = cut_lineage(E.update_employees(t["employees"], t["worker_staging"], t["employee_job_titles"]))
    return HI.update_history(_rekeyed_history(t), emp, AS_OF)


@query("assign_ids", """
SELECT ROW_NUMBER() OVER (ORDER BY employee_id, date) AS id, employee_id, job_title_id, date,
       work_minutes, paid_minutes, regular_minutes FROM fx_employee_hours
""")
def q_assign_ids(t):
    """DML-13: dense ids in key order without a global window."""
    return assign_ids(t["employee_hours"], ["employee_id", "date"]).select(
        "id", "employee_id", "job_title_id", "date", "work_minutes", "paid_minutes", "regular_minutes")


# ------------------------------------------------------------------- accounts
def _ad(fx: str, alias: str) -> str:
    return ", ".join(f"{col_sql(fx, 'network_users', c, alias)} AS {c}" for c in A.AD_COLUMNS)


_DIFF_SQL = f"SELECT {_ad('fx_network_snapshot', 's')} FROM fx_network_snapshot s EXCEPT SELECT {_ad('fx_network_users', 'u')} FROM fx_network_users u"


@query("snapshot_diff", _DIFF_SQL)
def q_snapshot_diff(t):
    """DML-18 / SET-2: snapshot rows that differ from the stored accounts."""
    return A.account_diff(t["network_snapshot"], t["network_users"])


def _net_count_sql() -> str:
    pairs = [(col_sql("fx_network_users", "network_users", c, "u"), col_sql("fx_network_snapshot", "network_users", c, "s"))
             for c in A.COUNTED]
    return f"""
SELECT COUNT(CASE WHEN {_diff_pred(pairs, False)} THEN 1 END) AS changed_reference,
       COUNT(CASE WHEN {_diff_pred(pairs, True)} THEN 1 END) AS changed
FROM fx_network_users u JOIN fx_network_snapshot s ON u.guid = s.guid"""


@query("net_change_count", _net_count_sql())
def q_net_change_count(t):
    """DML-20c: changed accounts, NULL-unsafe (reference) and NULL-safe."""
    return A.account_change_count(t["network_users"], t["network_snapshot"])


def _net_update_sql() -> str:
    out = []
    for c in cols("network_users"):
        cur = col_sql("fx_network_users", "network_users", c, "u")
        if c in A.AD_COLUMNS:
            out.append(f"CASE WHEN d.guid IS NOT NULL THEN d.{c} ELSE {cur} END AS {c}")
        elif c == "disabled_at":
            out.append(f"CASE WHEN d.guid IS NULL THEN {cur} "
                       f"WHEN u.is_disabled = FALSE AND d.is_disabled = TRUE THEN {TS} "
                       f"WHEN d.is_disabled = TRUE THEN {cur} END AS {c}")
        else:
            out.append(f"{cur} AS {c}")
    return (f"WITH d AS (SELECT * FROM ({_DIFF_SQL}) QUALIFY ROW_NUMBER() OVER (PARTITION BY guid "
            f"ORDER BY created_at DESC NULLS LAST, source ASC NULLS FIRST, account_name ASC NULLS FIRST) = 1) "
            f"SELECT {', '.join(out)} FROM fx_network_users u LEFT JOIN d ON u.guid = d.guid")


@query("net_update", _net_update_sql())
def q_net_update(t):
    """DML-20: changed accounts take the snapshot's values."""
    diff = A.account_diff(t["network_snapshot"], t["network_users"])
    return A.update_accounts(t["network_users"], diff, AS_OF)


def _flag_sql(mode: str) -> str:
    out = []
    present = "u.guid IN (SELECT guid FROM fx_network_snapshot WHERE guid IS NOT NULL)"
    for c in cols("network_users"):
        cur = col_sql("fx_network_users", "network_users", c, "u")
        if mode == "undelete":
            hit = f"({present} AND u.is_deleted = TRUE)"
            val = {"is_deleted": "FALSE", "deleted_at": "CAST(NULL AS TIMESTAMP)"}
        else:
            hit = f"(NOT ({present}) AND u.is_deleted = FALSE)"
            val = {"is_deleted": "TRUE", "deleted_at": TS}
        out.append(f"CASE WHEN {hit} THEN {val[c]} ELSE {cur} END AS {c}" if c in val else f"{cur} AS {c}")
    return f"SELECT {', '.join(out)} FROM fx_network_users u"


@query("net_undelete", _flag_sql("undelete"))
def q_net_undelete(t):
    """DML-21: deleted accounts present again are undeleted."""
    return A.undelete_accounts(t["network_users"], t["network_snapshot"])


@query("net_soft_delete", _flag_sql("delete"))
def q_net_soft_delete(t):
    """DML-22: accounts absent from the snapshot are flagged deleted."""
    return A.soft_delete_accounts(t["network_users"], t["network_snapshot"], AS_OF)


def _net_insert_sql() -> str:
    new = []
    for c in cols("network_users"):
        if c == "id":
            new.append("CAST((SELECT MAX(id) FROM fx_network_users) + ROW_NUMBER() OVER (ORDER BY d.guid) AS BIGINT)")
        elif c in A.AD_COLUMNS:
            new.append(f"d.{c}")
        else:
            new.append({"primary_guid": "d.guid", "inserted_at": TS, "is_primary_acct": "TRUE",
                        "is_non_user": "FALSE", "is_deleted": "FALSE",
                        "disabled_at": f"CASE WHEN d.is_disabled = TRUE THEN {TS} END",
                        "deleted_at": "CAST(NULL AS TIMESTAMP)"}[c])
    return (f"SELECT {conformed_sql('fx_network_users', 'network_users', 'u')} FROM fx_network_users u UNION ALL "
            f"SELECT {', '.join(new)} FROM ({_DIFF_SQL}) d "
            "WHERE d.guid IS NOT NULL AND d.guid NOT IN (SELECT guid FROM fx_network_users WHERE guid IS NOT NULL)")


@query("net_insert", _net_insert_sql())
def q_net_insert(t):
    """DML-23: accounts with a new guid appended (ids continue in guid order)."""
    diff = A.account_diff(t["network_snapshot"], t["network_users"])
    return A.insert_accounts(t["network_users"], diff, AS_OF)


@query("net_reconcile", None)
def q_net_reconcile(t):
    """DML-18..23 chained: one directory run (update, undelete, delete, insert)."""
    return A.reconcile_accounts(t["network_users"], t["network_snapshot"], AS_OF)


@query("net_reconcile_short_circuit", None)
def q_net_reconcile_short_circuit(t):
    """DML-19: the run with the reference's early exit (no diff rows: no deletes / undeletes either)."""
    return A.reconcile_accounts(t["network_users"], t["network_snapshot"], AS_OF, short_circuit=True)


def _unchanged_part(t):
    """A snapshot of two thirds of the stored accounts, exactly as they are stored."""
    users = conform(t["network_users"], "network_users")
    return users.where(F.col("id") % 3 != 0).select(*A.AD_COLUMNS)


@query("net_reconcile_no_diff", None)
def q_net_reconcile_no_diff(t):
    """DML-19: no diff, so that the early exit leaves the accounts that the snapshot lacks."""
    return A.reconcile_accounts(t["network_users"], _unchanged_part(t), AS_OF, short_circuit=True)


@query("net_reconcile_no_diff_full", None)
def q_net_reconcile_no_diff_full(t):
    """DML-20 to 23 on the same snapshot without the early exit: accounts that it lacks are deleted."""
    return A.reconcile_accounts(t["network_users"], _unchanged_part(t), AS_OF)


@query("emp_upsert", None)
def q_emp_upsert(t):
    """DML-5..9 chained: update, insert, soft delete of employees in one run."""
    emp, _ = E.upsert_employees(t["employees"], t["employee_info"], t["worker_staging"], t["employee_job_titles"], AS_OF)
    return emp


@query("run_log", f"""
WITH d AS ({_DIFF_SQL}),
c AS ({_net_count_sql()})
SELECT CAST(NULL AS BIGINT) AS id, 'directory' AS query_type, {TS} AS logged_at,
  (SELECT COUNT(*) FROM d) AS query_count, c.changed_reference AS update_count,
  (SELECT COUNT(*) FROM d WHERE guid IS NOT NULL AND guid NOT IN (SELECT guid FROM fx_network_users WHERE guid IS NOT NULL)) AS insert_count,
  CAST(NULL AS VARCHAR) AS failure_step, CAST(NULL AS VARCHAR) AS warnings, TRUE AS is_success
FROM c
""")
def q_run_log(t):
    """SNK-2 / DML-33: the run-log row of a directory run, counted before the change."""
    counts = A.account_counts(t["network_users"], t["network_snapshot"])
    return run_log_row(counts, "directory", AS_OF, query_count="diff_rows", update_count="changed_reference",
                       insert_count="inserted")

