"""Oracle SQL of the chained runs (one run = several statements in order).

Each statement of a run is a CTE reading the previous one, as the reference's
transaction applies them one after another.
"""

from __future__ import annotations

from staffline.operators import accounts as A
from staffline.plans.identity_q import _USER_COLS, _dup_sql
from staffline.plans.oracle import with_fixtures
from staffline.plans.reconcile_q import (_DIFF_SQL, _REKEYED, TS, _emp_update_sql, cols, conformed_sql)
from staffline.plans.registry import ORACLES

_HIST = "id, employee_id, job_title_id, start_date, end_date, inserted_at"


def _hist_chain() -> str:
    return f"""
WITH {_REKEYED},
emp AS ({_emp_update_sql()}),
new AS (SELECT id AS employee_id, job_title_id, start_date FROM emp
        WHERE id IS NOT NULL AND job_title_id IS NOT NULL AND start_date IS NOT NULL
        EXCEPT SELECT employee_id, job_title_id, start_date FROM jh),
h1 AS (SELECT {_HIST} FROM jh
       UNION ALL
       SELECT CAST((SELECT MAX(id) FROM fx_job_history) + ROW_NUMBER() OVER (ORDER BY start_date, employee_id, job_title_id) AS BIGINT),
              employee_id, job_title_id, start_date, CAST(NULL AS DATE), {TS} FROM new),
last AS (SELECT employee_id, MAX(inserted_at) AS m FROM h1 GROUP BY employee_id),
h2 AS (SELECT h.id, h.employee_id, h.job_title_id, h.start_date,
         CASE WHEN h.inserted_at = last.m AND e.termination_date IS NOT NULL AND h.end_date IS NULL
              THEN e.termination_date ELSE h.end_date END AS end_date, h.inserted_at
       FROM h1 h LEFT JOIN last ON h.employee_id = last.employee_id LEFT JOIN emp e ON h.employee_id = e.id),
r AS (SELECT id, employee_id, start_date,
        ROW_NUMBER() OVER (PARTITION BY employee_id ORDER BY inserted_at DESC, id DESC) AS rn FROM h2),
upd AS (SELECT p.id, c.start_date - 1 AS e FROM r p JOIN r c ON p.employee_id = c.employee_id
        WHERE p.rn = 2 AND c.rn = 1 AND p.start_date < c.start_date - 1),
h3 AS (SELECT h.id, h.employee_id, h.job_title_id, h.start_date,
         CASE WHEN upd.id IS NOT NULL THEN upd.e ELSE h.end_date END AS end_date, h.inserted_at
       FROM h2 h LEFT JOIN upd ON h.id = upd.id)
SELECT {_HIST} FROM h3
QUALIFY ROW_NUMBER() OVER (PARTITION BY employee_id, start_date ORDER BY inserted_at DESC, id DESC) = 1"""


def _emp_chain() -> str:
    all_cols = cols("employees")
    new = {"job_title_id": "s.title_sk", "inserted_at": TS, "is_deleted": "FALSE",
           "deleted_at": "CAST(NULL AS TIMESTAMP)"}
    new_sel = ", ".join(f"{new.get(c, 's.' + c)} AS {c}" for c in all_cols)
    gone = "(x.aoid NOT IN (SELECT aoid FROM fx_worker_staging WHERE aoid IS NOT NULL) AND x.is_deleted = FALSE)"
    final = ", ".join(
        f"CASE WHEN {gone} THEN TRUE ELSE x.is_deleted END AS is_deleted" if c == "is_deleted" else
        f"CASE WHEN {gone} THEN {TS} ELSE x.deleted_at END AS deleted_at" if c == "deleted_at" else f"x.{c}"
        for c in all_cols)
    return f"""
WITH s1 AS ({_emp_update_sql()}),
s2 AS (SELECT * FROM s1 UNION ALL
       SELECT {new_sel} FROM (SELECT w.*, jt.id AS title_sk FROM fx_worker_staging w JOIN fx_job_titles jt
         ON w.job_title_id = jt.job_title_id AND w.job_title = jt.job_title) s
       WHERE s.aoid NOT IN (SELECT aoid FROM s1 WHERE aoid IS NOT NULL))
SELECT {final} FROM s2 x"""


def _net_chain(short_circuit: bool = False) -> str:
    all_cols = cols("network_users")
    upd = []
    for c in all_cols:
        if c in A.AD_COLUMNS:
            upd.append(f"CASE WHEN d.guid IS NOT NULL THEN d.{c} ELSE u.{c} END AS {c}")
        elif c == "disabled_at":
            upd.append(f"CASE WHEN d.guid IS NULL THEN u.disabled_at "
                       f"WHEN u.is_disabled = FALSE AND d.is_disabled = TRUE THEN {TS} "
                       f"WHEN d.is_disabled = TRUE THEN u.disabled_at END AS disabled_at")
        else:
            upd.append(f"u.{c}")
    present = "u.guid IN (SELECT guid FROM fx_network_snapshot WHERE guid IS NOT NULL)"

    def flag(src: str, hit: str, vals: dict) -> str:
        return ", ".join(f"CASE WHEN {hit} THEN {vals[c]} ELSE u.{c} END AS {c}" if c in vals else f"u.{c}"
                         for c in all_cols) + f" FROM {src} u"

    new = []
    for c in all_cols:
        if c == "id":
            new.append("CAST((SELECT MAX(id) FROM s3) + ROW_NUMBER() OVER (ORDER BY n.guid) AS BIGINT)")
        elif c in A.AD_COLUMNS:
            new.append(f"n.{c}")
        else:
            new.append({"primary_guid": "n.guid", "inserted_at": TS, "is_primary_acct": "TRUE",
                        "is_non_user": "FALSE", "is_deleted": "FALSE",
                        "disabled_at": f"CASE WHEN n.is_disabled = TRUE THEN {TS} END",
                        "deleted_at": "CAST(NULL AS TIMESTAMP)"}[c])
    body = f"""
WITH s0 AS (SELECT {conformed_sql('fx_network_users', 'network_users', 'u')} FROM fx_network_users u),
diff AS ({_DIFF_SQL}),
d AS (SELECT * FROM diff QUALIFY ROW_NUMBER() OVER (PARTITION BY guid
      ORDER BY created_at DESC NULLS LAST, source ASC NULLS FIRST, account_name ASC NULLS FIRST) = 1),
s1 AS (SELECT {', '.join(upd)} FROM s0 u LEFT JOIN d ON u.guid = d.guid),
s2 AS (SELECT {flag('s1', f'({present} AND u.is_deleted = TRUE)', {'is_deleted': 'FALSE', 'deleted_at': 'CAST(NULL AS TIMESTAMP)'})}),
s3 AS (SELECT {flag('s2', f'(NOT ({present}) AND u.is_deleted = FALSE)', {'is_deleted': 'TRUE', 'deleted_at': TS})}),
s4 AS (SELECT * FROM s3 UNION ALL
       SELECT {', '.join(new)} FROM diff n
       WHERE n.guid IS NOT NULL AND n.guid NOT IN (SELECT guid FROM s3 WHERE guid IS NOT NULL))"""
    if short_circuit:
        return body + """
SELECT * FROM s4 WHERE (SELECT COUNT(*) FROM diff) > 0
UNION ALL SELECT * FROM s0 WHERE (SELECT COUNT(*) FROM diff) = 0"""
    return body + "\nSELECT * FROM s4"


def _dup_chain() -> str:
    names = ["email", "primary_email", "network_email", "common_name"]
    sel = ", ".join(_USER_COLS)
    ctes, src = [], "fx_network_users"
    for i, n in enumerate(names):
        step = _dup_sql(n).replace("FROM fx_network_users u", f"FROM {src} u")
        ctes.append(f"p{i} AS (SELECT {sel} FROM ({step}))")
        src = f"p{i}"
    return "WITH " + ",\n".join(ctes) + f"\nSELECT * FROM {src}"


_PART = "(SELECT * FROM fx_network_users WHERE id % 3 <> 0)"

ORACLES.update({
    "hist_update": with_fixtures(_hist_chain()),
    "emp_upsert": with_fixtures(_emp_chain()),
    "net_reconcile": with_fixtures(_net_chain()),
    "net_reconcile_short_circuit": with_fixtures(_net_chain(short_circuit=True)),
    "net_reconcile_no_diff": with_fixtures(_net_chain(short_circuit=True).replace("fx_network_snapshot", _PART)),
    "net_reconcile_no_diff_full": with_fixtures(_net_chain().replace("fx_network_snapshot", _PART)),
    "dup_all": with_fixtures(_dup_chain()),
})
