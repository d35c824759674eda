"""Query keys of duplicate-account resolution (DML-24..29, WIN-1) and
identity linkage (DML-30..32, WIN-2, JOIN-7/7b)."""

from __future__ import annotations

from staffline.operators import dedupe as D
from staffline.operators import linkage as LK
from staffline.plans.reconcile_q import FX_COLS, col_sql, cols
from staffline.plans.registry import query


_ORG = "'%organizationname.org%'"
_DUP_KEYS = {
    "email": ("u.email", True), "primary_email": ("u.primary_email", True),
    "network_email": ("u.network_email", True), "common_name": ("u.common_name", False),
    "display_name": ("u.display_name", False),
    "concat_name": ("concat_ws(' ', u.first_name, u.last_name)", False),
}
_USER_COLS = FX_COLS["fx_network_users"]


def _ranked_sql(name: str) -> str:
    key, org = _DUP_KEYS[name]
    valid = "k.key <> ''" if name == "concat_name" else "k.key IS NOT NULL"
    flag = f"(CASE WHEN k.key LIKE {_ORG} THEN 1 ELSE 0 END) DESC NULLS LAST, " if org else ""
    return f"""
k AS (SELECT u.*, {key} AS key, CAST(NULL AS TIMESTAMP) AS inserted_at FROM fx_network_users u),
dupes AS (SELECT key FROM k WHERE {valid.replace('k.', '')} AND is_non_user = FALSE AND is_primary_acct = TRUE
          GROUP BY key HAVING COUNT(*) > 1),
ranked AS (SELECT k.id, k.guid, k.key, ROW_NUMBER() OVER (PARTITION BY k.key ORDER BY k.is_deleted ASC NULLS FIRST,
             k.is_disabled ASC NULLS FIRST, {flag}k.created_at DESC NULLS LAST, k.inserted_at DESC NULLS LAST,
             k.id ASC) AS rn
           FROM k JOIN dupes ON k.key = dupes.key WHERE {valid} AND k.is_non_user = FALSE)"""


def _dup_sql(name: str) -> str:
    out = []
    for c in _USER_COLS:
        if c == "is_primary_acct":
            out.append("CASE WHEN upd.id IS NOT NULL THEN FALSE ELSE u.is_primary_acct END AS is_primary_acct")
        elif c == "primary_guid":
            out.append("CASE WHEN upd.id IS NOT NULL THEN upd.pguid ELSE u.primary_guid END AS primary_guid")
        else:
            out.append(f"u.{c}")
    return (f"WITH {_ranked_sql(name)},\nupd AS (SELECT s.id, p.guid AS pguid FROM ranked p JOIN ranked s "
            f"ON p.key = s.key WHERE p.rn = 1 AND s.rn > 1)\n"
            f"SELECT {', '.join(out)} FROM fx_network_users u LEFT JOIN upd ON u.id = upd.id")


def _register_dup(name: str):
    def q(t):
        return D.resolve_duplicates(t["network_users"], name)

    q.__doc__ = f"DML-24..29: duplicate accounts by {name} demoted to secondary."
    return query(f"dup_{name}", _dup_sql(name))(q)


for _name in D.RESOLVERS:
    _register_dup(_name)


@query("dup_priority", f"WITH {_ranked_sql('email')}\nSELECT key AS __key, id AS __winner_id, guid AS __winner_guid "
       "FROM ranked WHERE rn = 1")
def q_dup_priority(t):
    """WIN-1: the winning account per duplicated e-mail (partial aggregate, no window)."""
    return D.duplicate_winners(t["network_users"], "email")


@query("dup_all", None)
def q_dup_all(t):
    """The directory run's resolver sequence (email, primary e-mail, network e-mail, common name)."""
    return D.resolve_all(t["network_users"], checkpoint_between=True)


def _n(x: str) -> str:
    return f"trim(lower({x}))"


def _email_match(cand: str) -> str:
    return (f"({_n(cand)} <> '' AND ({_n(cand)} = {_n('u.network_email')} OR {_n(cand)} = {_n('u.email')} "
            f"OR {_n(cand)} = {_n('u.primary_email')}))")


@query("email_link", f"""
WITH users AS (SELECT * FROM fx_network_users WHERE is_non_user = FALSE AND is_primary_acct = TRUE
               AND id NOT IN (SELECT network_id FROM fx_workforce_map WHERE network_id IS NOT NULL)),
emps AS (SELECT * FROM fx_employees WHERE id NOT IN (SELECT employee_id FROM fx_workforce_map WHERE employee_id IS NOT NULL)),
pairs AS (SELECT u.id AS network_id, e.id AS employee_id FROM users u JOIN emps e ON {_email_match('e.work_email')}),
links AS (SELECT MIN(network_id) AS network_id, employee_id FROM pairs GROUP BY employee_id
          UNION SELECT network_id, MIN(employee_id) FROM pairs GROUP BY network_id)
SELECT network_id, employee_id FROM links
""")
def q_email_link(t):
    """DML-30 / JOIN-7: new account <-> employee links by e-mail (exploded-key equi-join)."""
    return LK.link_employees(t["network_users"], t["employees"], t["workforce_map"])


def _map_out(col: str, expr: str) -> str:
    out = []
    for c in cols("workforce_map"):
        cur = col_sql("fx_workforce_map", "workforce_map", c, "m")
        out.append(f"{expr} AS {c}" if c == col else f"{cur} AS {c}")
    return ", ".join(out)


@query("analytics_link", f"""
WITH free AS (SELECT * FROM fx_analytics_users
              WHERE id NOT IN (SELECT analytics_id FROM fx_workforce_map WHERE analytics_id IS NOT NULL)),
pairs AS (SELECT u.id AS network_id, a.id AS aid FROM free a JOIN fx_network_users u ON {_email_match('a.email')}),
per_user AS (SELECT network_id, MIN(aid) AS aid FROM pairs GROUP BY network_id),
upd AS (SELECT m.id, p.aid FROM fx_workforce_map m JOIN per_user p ON m.network_id = p.network_id)
SELECT {_map_out('analytics_id', f"CASE WHEN upd.id IS NOT NULL THEN upd.aid ELSE m.analytics_id END")}
FROM fx_workforce_map m LEFT JOIN upd ON m.id = upd.id
""")
def q_analytics_link(t):
    """DML-31: analytics user id set on map rows matched by e-mail."""
    return LK.link_analytics(t["analytics_users"], t["network_users"], t["workforce_map"])


def _ehr_users(t):
    """The EHR's two user tables (user rows, e-mails), joined as the linkage reads them."""
    return LK.join_ehr_users(t["ehr_users"].drop("email"), t["ehr_users"])


_EHR_ROWS = """
e AS (SELECT *, CASE WHEN strpos(name, ',') > 0 THEN lower(trim(substr(name, strpos(name, ',') + 1))) END AS first_name,
             CASE WHEN strpos(name, ',') > 0 THEN lower(left(name, strpos(name, ',') - 1)) END AS last_name
      FROM fx_ehr_users WHERE user_id NOT IN ('SA000')),
e2 AS (SELECT *, CASE WHEN first_name IS NOT NULL THEN concat(first_name, ' ', last_name) END AS reformatted_name FROM e),
best AS (SELECT * FROM e2 QUALIFY ROW_NUMBER() OVER (PARTITION BY name ORDER BY CASE WHEN email IS NULL THEN 1 ELSE 0 END,
         user_status_c ASC NULLS FIRST, last_pw_update DESC NULLS LAST, user_id ASC) = 1)"""


@query("ehr_best_row", f"WITH {_EHR_ROWS}\nSELECT * FROM best")
def q_ehr_best_row(t):
    """WIN-2 / SRT-2: one EHR row per name (e-mail first, status, latest password change)."""
    return LK.best_ehr_rows(_ehr_users(t)).select(*t["ehr_users"].columns, "first_name", "last_name", "reformatted_name")


_FULL = f"({_n('c.reformatted_name')} <> '' AND {_n('c.reformatted_name')} = {_n('u.common_name')})"
_FL = (f"({_n('c.first_name')} <> '' AND {_n('c.last_name')} <> '' AND {_n('c.first_name')} = {_n('u.first_name')} "
       f"AND {_n('c.last_name')} = {_n('u.last_name')})")


@query("ehr_link", f"""
WITH {_EHR_ROWS},
cand AS (SELECT * FROM best WHERE user_id NOT IN (SELECT CAST(epic_id AS VARCHAR) FROM fx_workforce_map WHERE epic_id IS NOT NULL)),
pairs AS (SELECT u.id AS network_id, c.user_id,
            CASE WHEN {_email_match('c.email')} THEN 0 WHEN {_FULL} THEN 1 ELSE 2 END AS r
          FROM cand c JOIN fx_network_users u ON {_email_match('c.email')} OR {_FULL} OR {_FL}),
per_user AS (SELECT network_id, user_id FROM pairs QUALIFY ROW_NUMBER() OVER (PARTITION BY network_id ORDER BY r, user_id) = 1),
upd AS (SELECT m.id, p.user_id FROM fx_workforce_map m JOIN per_user p ON m.network_id = p.network_id WHERE m.epic_id IS NULL)
SELECT {_map_out('epic_id', "CASE WHEN upd.id IS NOT NULL THEN upd.user_id ELSE CAST(m.epic_id AS VARCHAR) END")}
FROM fx_workforce_map m LEFT JOIN upd ON m.id = upd.id
""")
def q_ehr_link(t):
    """DML-32 / JOIN-7b: EHR user id set on map rows matched by e-mail, full name or first + last."""
    return LK.link_ehr(_ehr_users(t), t["network_users"], t["workforce_map"])
