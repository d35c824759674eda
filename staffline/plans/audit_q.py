"""Query keys of the integrity audits and JSON-id expansion."""

from __future__ import annotations

from pyspark.sql import functions as F

from staffline.operators import audit as AU
from staffline.plans.reconcile_q import col_sql
from staffline.plans.registry import ORACLES, query

_ENTITY = {"employee": "fx_employees", "contractor": "fx_contractors", "learner": "fx_learners",
           "volunteer": "fx_volunteers"}
_TABLE = {"employee": "employees", "contractor": "contractors", "learner": "learners", "volunteer": "volunteers"}


@query("aud_unmapped_employee", """
SELECT id FROM fx_employees WHERE termination_date IS NULL OR YEAR(termination_date) >= 2023
EXCEPT SELECT employee_id FROM fx_workforce_map
""")
def q_aud_unmapped_employee(t):
    """AUD-1: active (or left since 2023) employees missing from the map."""
    return AU.unmapped_employees(t["employees"], t["workforce_map"], 2023)


def _register_entity(kind: str):
    col = AU.MAP_COLUMNS[kind]
    if kind != "employee":
        def q_unmapped(t):
            return AU.unmapped_entities(t[_TABLE[kind]], t["workforce_map"], kind)
        q_unmapped.__doc__ = f"AUD-3..7: {kind}s missing from the map."
        query(f"aud_unmapped_{kind}", f"SELECT id FROM {_ENTITY[kind]} EXCEPT SELECT {col} FROM fx_workforce_map")(q_unmapped)

    def q_orphan(t):
        return AU.orphan_ids(t["workforce_map"], t[_TABLE[kind]], kind)
    q_orphan.__doc__ = f"AUD-2..8: mapped {kind} ids that do not exist."
    query(f"aud_orphan_{kind}",
          f"SELECT {col} FROM fx_workforce_map WHERE {col} IS NOT NULL EXCEPT SELECT id FROM {_ENTITY[kind]}")(q_orphan)


for _k in _ENTITY:
    _register_entity(_k)


def _encounters(t):
    """Provider visits derived from orders (one per order, provider = customer)."""
    return t["orders"].select(F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("visit_prov_id"))


@query("aud_unmapped_ehr", """
SELECT DISTINCT CAST(p.user_id AS VARCHAR) AS user_id FROM fx_clinical_providers p
WHERE p.user_id IS NOT NULL AND p.serv_area_id = 1 AND p.user_id NOT IN ('1', '721') AND p.prov_id IN (SELECT concat('P', CAST(o_custkey AS VARCHAR)) FROM orders)
EXCEPT SELECT CAST(epic_id AS VARCHAR) FROM fx_workforce_map WHERE epic_id IS NOT NULL
""")
def q_aud_unmapped_ehr(t):
    """AUD-9: EHR providers with encounters whose user id is not mapped."""
    return AU.unmapped_ehr(t["clinical_providers"], t["workforce_map"], _encounters(t), service_area=1,
                           service_accounts=("1", "721"))


@query("aud_orphan_ehr", """
SELECT CAST(epic_id AS VARCHAR) AS epic_id FROM fx_workforce_map WHERE epic_id IS NOT NULL
EXCEPT SELECT CAST(user_id AS VARCHAR) FROM fx_ehr_users
""")
def q_aud_orphan_ehr(t):
    """AUD-10: mapped EHR ids unknown to the EHR."""
    return AU.orphan_ehr(t["workforce_map"], t["ehr_users"])


_ACCT_COLS = ["id", "source", "first_name", "last_name", "common_name", "network_email", "primary_email",
              "email", "job_title", "account_name", "active_dir_group", "department", "location",
              "user_description", "phone_extension", "mobile_phone", "created_at", "inserted_at",
              "is_disabled", "disabled_at", "is_deleted", "deleted_at"]


def _acct_sql(sql_null: bool) -> str:
    sel = ", ".join(f"{col_sql('fx_network_users', 'network_users', c, 'u')} AS {c}" for c in _ACCT_COLS)
    sub = "SELECT network_id FROM fx_workforce_map" + ("" if sql_null else " WHERE network_id IS NOT NULL")
    dis = col_sql("fx_network_users", "network_users", "disabled_at", "u")
    dele = col_sql("fx_network_users", "network_users", "deleted_at", "u")
    return (f"SELECT {sel} FROM fx_network_users u WHERE u.id NOT IN ({sub}) AND u.is_primary_acct = TRUE "
            f"AND u.is_non_user = FALSE AND COALESCE(YEAR({dis}), 2024) >= 2024 AND COALESCE(YEAR({dele}), 2024) >= 2024")


@query("aud_unmapped_account", _acct_sql(False))
def q_aud_unmapped_account(t):
    """AUD-11: primary real-user accounts not mapped (NULL map ids ignored)."""
    return AU.unmapped_accounts(t["network_users"], t["workforce_map"], 2024)


@query("aud_unmapped_account_sql", _acct_sql(True))
def q_aud_unmapped_account_sql(t):
    """AUD-11 with SQL NOT IN semantics (a NULL network_id in the map empties it)."""
    return AU.unmapped_accounts(t["network_users"], t["workforce_map"], 2024, sql_null_semantics=True)


@query("aud_dup_network", "SELECT network_id, COUNT(*) AS count FROM fx_workforce_map GROUP BY network_id HAVING COUNT(*) > 1")
def q_aud_dup_network(t):
    """AUD-12: network ids used by several people (the NULL group counts too)."""
    return AU.duplicate_ids(t["workforce_map"], "network_id", include_null=True)


def _register_dup(name: str, col: str):
    expr = col_sql("fx_workforce_map", "workforce_map", col, "m")

    def q(t):
        return AU.duplicate_ids(t["workforce_map"], col)
    q.__doc__ = f"AUD-13..18: {col} used by several people."
    query(f"aud_dup_{name}", f"SELECT {expr} AS {col}, COUNT(*) AS count FROM fx_workforce_map m "
                             f"WHERE {expr} IS NOT NULL GROUP BY {expr} HAVING COUNT(*) > 1")(q)


for _name, _col in [("employee", "employee_id"), ("contractor", "contractor_id"), ("learner", "learner_id"),
                    ("volunteer", "volunteer_id"), ("relevant", "relevant_id"), ("epic", "epic_id")]:
    _register_dup(_name, _col)


def _all_sql() -> str:
    def part(finding: str, kind: str, key: str, people: str, rows: str) -> str:
        return f"SELECT '{finding}' AS finding, '{kind}' AS kind, CAST({key} AS VARCHAR) AS key, CAST({people} AS BIGINT) AS people FROM ({rows})"

    parts = []
    for kind, table in _ENTITY.items():
        col = AU.MAP_COLUMNS[kind]
        due = " WHERE termination_date IS NULL OR YEAR(termination_date) >= 2023" if kind == "employee" else ""
        parts.append(part("unmapped", kind, "id", "0", f"SELECT id FROM {table}{due} EXCEPT SELECT {col} FROM fx_workforce_map"))
        parts.append(part("orphan", kind, col, "n", f"SELECT {col}, COUNT(*) AS n FROM fx_workforce_map WHERE {col} IS NOT NULL "
                                                    f"AND {col} NOT IN (SELECT id FROM {table}) GROUP BY {col}"))
    parts.append(part("unmapped", "epic", "user_id", "0", ORACLES["aud_unmapped_ehr"]))
    parts.append(part("orphan", "epic", "epic_id", "n", "SELECT epic_id, COUNT(*) AS n FROM fx_workforce_map WHERE epic_id IS NOT NULL AND "
                      "CAST(epic_id AS VARCHAR) NOT IN (SELECT CAST(user_id AS VARCHAR) FROM fx_ehr_users WHERE user_id IS NOT NULL) GROUP BY epic_id"))
    for kind, col in AU.AUDITED.items():
        parts.append(part("duplicate", kind, col, "count", ORACLES[f"aud_dup_{kind}"]))
    return " UNION ALL ".join(parts)


@query("audit_all", _all_sql())
def q_audit_all(t):
    """AUD-1..10, 12..18: unmapped, orphan and duplicate findings of all kinds from one pass over the map."""
    there, due = F.lit(True).alias("exists"), F.lit(True).alias("expected")
    entities = {kind: t[table].select("id", there, due if kind != "employee" else AU.expected_employee(2023).alias("expected"))
                for kind, table in _TABLE.items()}
    ehr = AU.expected_ehr(t["clinical_providers"], _encounters(t), service_area=1, service_accounts=("1", "721"))
    users = t["ehr_users"].select(F.col("user_id").cast("string").alias("id"), there, F.lit(False).alias("expected"))
    entities["epic"] = users.unionByName(ehr.select(F.col("user_id").alias("id"), F.lit(False).alias("exists"), due))
    return AU.audit_all(t["workforce_map"], entities)


def _json_sql(inst: str, extra: str = "") -> str:
    return (f"SELECT id, {extra}'{inst}' AS source, unnest(CAST(json_extract(ecw_ids, '$.\"{inst}\"') AS VARCHAR[])) AS ecw_id "
            "FROM fx_workforce_map")


@query("json_ids", f"{_json_sql('ecw instance 1', 'network_id, ')} UNION ALL {_json_sql('ecw instance 2', 'network_id, ')}")
def q_json_ids(t):
    """JOIN-13 / SCA-22: ids listed in the JSON column, one row each."""
    return AU.json_ids(t["workforce_map"])


@query("aud_dup_json", f"""
WITH all_ids AS ({_json_sql('ecw instance 1')} UNION {_json_sql('ecw instance 2')})
SELECT source, ecw_id, COUNT(*) AS count FROM all_ids GROUP BY source, ecw_id HAVING COUNT(*) > 1
""")
def q_aud_dup_json(t):
    """AUD-19: clinical ids (from the JSON column) used by several people."""
    return AU.duplicate_json_ids(t["workforce_map"])


def _names_part(inst: str) -> str:
    pe = col_sql("fx_network_users", "network_users", "primary_email", "nu")
    return f"""
SELECT j.id, '{inst}' AS source, cu.uid AS ecw_id, COALESCE(nu.email, {pe}, nu.network_email) AS network_email,
  lower(trim(cu.uemail)) AS ecw_email,
  CASE WHEN nu.common_name LIKE '% %' AND NOT regexp_matches(nu.common_name, '[0-9]') THEN nu.common_name
       ELSE concat(nu.first_name, ' ', nu.last_name) END AS network_name,
  concat_ws(' ', cu.ufname, cu.ulname) AS ecw_name
FROM ({_json_sql(inst, 'network_id, ')}) j
  LEFT JOIN fx_network_users nu ON j.network_id = nu.id
  LEFT JOIN fx_clinical_users cu ON j.ecw_id = cu.uid
WHERE cu.usertype IN (1, 2, 9)"""


@query("aud_json_names", f"{_names_part('ecw instance 1')} UNION {_names_part('ecw instance 2')}")
def q_aud_json_names(t):
    """AUD-20: directory vs clinical account name / e-mail of every linked clinical id."""
    return AU.json_name_check(t["workforce_map"], t["network_users"],
                              {"ecw instance 1": t["clinical_users"], "ecw instance 2": t["clinical_users"]})

