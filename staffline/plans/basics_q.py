"""Query keys of the single-operator forms: filters (2.5), joins (2.6),
aggregates (2.7), set operations (2.9) and scalar functions (2.10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from staffline.functions import (changed_null_safe, changed_null_unsafe, full_name_with_initial, has_digit,
                                 in_year, is_org_email, iso_duration_minutes, name_last_first, overlaps_year,
                                 round2, title_case, tsql_concat)
from staffline.functions.dates import clip_end, clip_start
from staffline.operators import audit as AU
from staffline.operators import hours as H
from staffline.operators.reconcile import anti_join, not_in, semi_join, spread_nulls
from staffline.params import Params
from staffline.plans.oracle import in_year as sql_in_year
from staffline.plans.oracle import rnd
from staffline.plans.reconcile_q import AS_OF, TS
from staffline.plans.registry import query
from staffline.plans.timecard_q import _DAILY, _daily
from staffline.plans.views_q import _hours_rows_sql
from staffline.schemas import conform

P2000 = Params(reporting_year=2000)


# -------------------------------------------------------------------- filters
@query("fil_1", f"SELECT employee_id, date, paid_minutes FROM fx_employee_hours WHERE YEAR(date) = 2000")
def q_fil_1(t):
    """FIL-1: YEAR(date) = year as a half-open range (Parquet stats prune)."""
    return t["employee_hours"].filter(in_year("date", 2000)).select("employee_id", "date", "paid_minutes")


@query("fil_2", """SELECT learner_id, start_date, end_date, hours FROM fx_learner_job_hours
WHERE end_date >= DATE '2024-01-01' AND start_date <= DATE '2024-12-31'""")
def q_fil_2(t):
    """FIL-2: interval overlaps the calendar year."""
    return (t["learner_job_hours"].filter(overlaps_year("start_date", "end_date", 2024))
            .select("learner_id", "start_date", "end_date", "hours"))


@query("fil_3", "SELECT volunteer_id, start_date, hours FROM fx_volunteer_job_hours WHERE COALESCE(hours, 0) > 0")
def q_fil_3(t):
    """FIL-3: positive hours (NULL counts as 0)."""
    return t["volunteer_job_hours"].filter(F.coalesce("hours", F.lit(0)) > 0).select("volunteer_id", "start_date", "hours")


@query("fil_4", """
SELECT u.guid,
  COALESCE(u.first_name != s.first_name OR u.last_name != s.last_name OR u.common_name != s.common_name
    OR u.network_email != s.network_email OR u.email != s.email OR u.job_title != s.job_title
    OR u.created_at != s.created_at OR u.is_disabled != s.is_disabled, FALSE) AS changed_reference,
  (u.first_name IS DISTINCT FROM s.first_name OR u.last_name IS DISTINCT FROM s.last_name
    OR u.common_name IS DISTINCT FROM s.common_name OR u.network_email IS DISTINCT FROM s.network_email
    OR u.email IS DISTINCT FROM s.email OR u.job_title IS DISTINCT FROM s.job_title
    OR u.created_at IS DISTINCT FROM s.created_at OR u.is_disabled IS DISTINCT FROM s.is_disabled) AS changed
FROM fx_network_users u JOIN fx_network_snapshot s ON u.guid = s.guid
""")
def q_fil_4(t):
    """FIL-4: OR of column inequalities, NULL-unsafe (reference) and NULL-safe."""
    cols = ["first_name", "last_name", "common_name", "network_email", "email", "job_title", "created_at", "is_disabled"]
    s = t["network_snapshot"].select("guid", *[F.col(c).alias(f"s_{c}") for c in cols])
    pairs = [(F.col(c), F.col(f"s_{c}")) for c in cols]
    return (t["network_users"].join(s, "guid")
            .select("guid", changed_null_unsafe(pairs).alias("changed_reference"),
                    changed_null_safe(pairs).alias("changed")))


@query("fil_5", "SELECT id, network_id FROM fx_workforce_map WHERE employee_id IS NULL AND network_id IS NOT NULL")
def q_fil_5(t):
    """FIL-5: IS NULL / IS NOT NULL."""
    return (t["workforce_map"].filter(F.col("employee_id").isNull() & F.col("network_id").isNotNull())
            .select("id", "network_id"))


@query("fil_6", "SELECT id, aoid FROM fx_employees WHERE id NOT IN (SELECT employee_id FROM fx_workforce_map WHERE employee_id IS NOT NULL)")
def q_fil_6(t):
    """FIL-6: NOT IN over a NULL-free subquery, as a shuffled anti join."""
    return anti_join(t["employees"], t["workforce_map"], "id", "employee_id").select("id", "aoid")


@query("fil_7", "SELECT id, employee_id, start_date FROM fx_job_history WHERE employee_id IN (SELECT employee_id FROM fx_workforce_map)")
def q_fil_7(t):
    """FIL-7 / JOIN-9: IN (subquery) as a left semi join."""
    return semi_join(t["employee_job_history"], t["workforce_map"], "employee_id").select("id", "employee_id", "start_date")


@query("fil_8", "SELECT uid, usertype FROM fx_clinical_users WHERE usertype IN (1, 2, 9)")
def q_fil_8(t):
    """FIL-8: IN (list)."""
    return t["clinical_users"].filter(F.col("usertype").isin(1, 2, 9)).select("uid", "usertype")


@query("fil_9", """SELECT id, common_name LIKE '% %' AS has_space, email LIKE '%organizationname.org%' AS org_email
FROM fx_network_users""")
def q_fil_9(t):
    """FIL-9: LIKE '% %' and LIKE '%domain%' as contains()."""
    return t["network_users"].select("id", F.col("common_name").contains(" ").alias("has_space"),
                                     is_org_email("email").alias("org_email"))


@query("fil_10", "SELECT id, NOT regexp_matches(common_name, '[0-9]') AS no_digit FROM fx_network_users")
def q_fil_10(t):
    """FIL-10: PATINDEX('%[0-9]%', x) = 0 as NOT rlike."""
    return t["network_users"].select("id", (~has_digit("common_name")).alias("no_digit"))


@query("fil_11", """SELECT id, employee_id FROM fx_job_history
WHERE DATE '2000-06-30' BETWEEN start_date AND COALESCE(end_date, DATE '2099-12-31')""")
def q_fil_11(t):
    """FIL-11: date BETWEEN start AND COALESCE(end, open end)."""
    d = F.lit(dt.date(2000, 6, 30))
    return (t["employee_job_history"]
            .filter(d.between(F.col("start_date"), F.coalesce("end_date", F.lit(dt.date(2099, 12, 31)))))
            .select("id", "employee_id"))


@query("fil_12", "SELECT id FROM fx_employees WHERE COALESCE(YEAR(termination_date), 2001) >= 2001")
def q_fil_12(t):
    """FIL-12: COALESCE(YEAR(x), y) >= y as (x IS NULL OR x >= Jan 1)."""
    return t["employees"].filter(F.col("termination_date").isNull()
                                 | (F.col("termination_date") >= F.lit(dt.date(2001, 1, 1)))).select("id")


@query("fil_13", f"""SELECT date, COUNT(date) AS n FROM fx_employee_hours WHERE YEAR(date) = 2000
GROUP BY date HAVING COUNT(date) > 5 AND date <= {TS}""")
def q_fil_13(t):
    """FIL-13: HAVING COUNT > n AND date <= as_of."""
    return (t["employee_hours"].filter(in_year("date", 2000)).groupBy("date").agg(F.count("date").alias("n"))
            .filter((F.col("n") > 5) & (F.col("date") <= F.lit(AS_OF).cast("date"))))


@query("fil_14", "SELECT user_id, name FROM fx_ehr_users WHERE user_id != 'SA000'")
def q_fil_14(t):
    """FIL-14: constant exclusion list."""
    return t["ehr_users"].filter(~F.col("user_id").isin("SA000")).select("user_id", "name")


# ---------------------------------------------------------------------- joins
@query("join_inner", "SELECT e.id, t.job_title FROM fx_employees e JOIN fx_job_titles t ON e.job_title_id = t.id")
def q_join_inner(t):
    """JOIN-1: inner equi-join."""
    tt = t["employee_job_titles"].select(F.col("id").alias("__tid"), "job_title")
    return t["employees"].join(tt, F.col("job_title_id") == F.col("__tid")).select("id", "job_title")


@query("join_compound", """SELECT w.aoid, t.id AS title_sk FROM fx_worker_staging w
JOIN fx_job_titles t ON w.job_title_id = t.job_title_id AND w.job_title = t.job_title""")
def q_join_compound(t):
    """JOIN-2: inner join on (job_title_id, job_title)."""
    tt = t["employee_job_titles"].select(F.col("id").alias("title_sk"), "job_title_id", "job_title")
    return t["worker_staging"].join(tt, ["job_title_id", "job_title"]).select("aoid", "title_sk")


@query("anti_join", f"""SELECT d.employee_id, d.date FROM ({_DAILY}) d
LEFT JOIN fx_employee_hours h ON d.employee_id = h.employee_id AND d.date = h.date WHERE h.employee_id IS NULL""")
def q_anti_join(t):
    """JOIN-5: LEFT JOIN ... IS NULL as left_anti (new timecard days)."""
    return _daily(t).join(t["employee_hours"].select("employee_id", "date"), ["employee_id", "date"], "left_anti") \
        .select("employee_id", "date")


@query("manager_lookup", """SELECT e.id, e.reports_to_id, concat_ws(' ', m.legal_first_name, left(m.legal_middle_name, 1), m.legal_last_name) AS manager
FROM fx_employees e LEFT JOIN fx_employees m ON e.reports_to_id = m.id""")
def q_manager_lookup(t):
    """JOIN-6: self join to the manager row."""
    m = t["employees"].select(F.col("id").alias("__mid"), F.col("legal_first_name").alias("__f"),
                              F.col("legal_middle_name").alias("__m"), F.col("legal_last_name").alias("__l"))
    return (t["employees"].withColumn("__boss", spread_nulls("reports_to_id"))
            .join(m, F.col("__boss") == F.col("__mid"), "left")
            .select("id", "reports_to_id", full_name_with_initial("__f", "__m", "__l").alias("manager")))


@query("not_in_null", "SELECT id FROM fx_network_users WHERE id NOT IN (SELECT network_id FROM fx_workforce_map)")
def q_not_in_null(t):
    """JOIN-8: exact SQL NOT IN (a NULL in the subquery empties the result)."""
    return not_in(t["network_users"], t["workforce_map"], "id", "network_id", sql_null_semantics=True).select("id")


@query("not_in_no_null", """SELECT id FROM fx_network_users
WHERE id NOT IN (SELECT network_id FROM fx_workforce_map WHERE network_id IS NOT NULL)""")
def q_not_in_no_null(t):
    """JOIN-8: exact SQL NOT IN over a subquery without NULLs."""
    links = t["workforce_map"].where(F.col("network_id").isNotNull())
    return not_in(t["network_users"], links, "id", "network_id", sql_null_semantics=True).select("id")


@query("semi_join", "SELECT id FROM fx_contractors WHERE id IN (SELECT contractor_id FROM fx_contractor_job_hours)")
def q_semi_join(t):
    """JOIN-9: IN (subquery) as left semi join."""
    return semi_join(t["contractors"], t["contractor_job_hours"], "id", "contractor_id").select("id")


@query("join_cross_one_row", f"""SELECT e.employee_id, e.date, c.count FROM fx_employee_hours e
CROSS JOIN (SELECT COUNT(*) * 8 AS count FROM (SELECT date FROM fx_employee_hours WHERE {sql_in_year('date', 2000)}
  GROUP BY date HAVING COUNT(date) > 5 AND date <= {TS})) c WHERE {sql_in_year('e.date', 2000)}""")
def q_join_cross_one_row(t):
    """JOIN-11: cross join with a one-row frame (broadcast, fixed size)."""
    wd = F.broadcast(H.workday_hours(t["employee_hours"], P2000, 5))
    return t["employee_hours"].filter(in_year("date", 2000)).select("employee_id", "date").crossJoin(wd)


# ----------------------------------------------------------------- aggregates
@query("agg_count", "SELECT COUNT(*) AS n FROM fx_workforce_map")
def q_agg_count(t):
    """AGG-1: COUNT(*)."""
    return t["workforce_map"].agg(F.count(F.lit(1)).alias("n"))


@query("agg_having", """SELECT email, COUNT(*) AS count FROM fx_network_users
WHERE email IS NOT NULL AND is_non_user = FALSE AND is_primary_acct = TRUE GROUP BY email HAVING COUNT(*) > 1""")
def q_agg_having(t):
    """AGG-2: grouped COUNT(*) with HAVING."""
    return (t["network_users"].filter(F.col("email").isNotNull() & (F.col("is_non_user") == F.lit(False))
                                      & (F.col("is_primary_acct") == F.lit(True)))
            .groupBy("email").agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1))


@query("agg_count_col", "SELECT job_title, COUNT(job_title) AS n FROM fx_network_users GROUP BY job_title")
def q_agg_count_col(t):
    """AGG-3: COUNT(col) skips NULLs."""
    return t["network_users"].groupBy("job_title").agg(F.count("job_title").alias("n"))


@query("agg_sum", f"""SELECT employee_id, CAST(SUM(paid_minutes) AS BIGINT) AS paid_minutes, {rnd('SUM(paid_minutes) / 60.0')} AS hours
FROM fx_employee_hours WHERE {sql_in_year('date', 2000)} GROUP BY employee_id""")
def q_agg_sum(t):
    """AGG-4: SUM of ints (bigint, not narrowed) and hours."""
    return (H.employee_minutes(t["employee_hours"], 2000)
            .withColumn("hours", round2(F.col("paid_minutes").cast("double") / 60.0)))


@query("agg_minmax", "SELECT contractor_id, MIN(start_date) AS start_date, MAX(end_date) AS end_date FROM fx_contractor_job_hours GROUP BY contractor_id")
def q_agg_minmax(t):
    """AGG-5: MIN / MAX dates."""
    return t["contractor_job_hours"].groupBy("contractor_id").agg(F.min("start_date").alias("start_date"),
                                                                  F.max("end_date").alias("end_date"))


@query("agg_last_row", """SELECT h.id, h.employee_id, h.inserted_at FROM fx_job_history h
JOIN (SELECT employee_id, MAX(inserted_at) AS m FROM fx_job_history GROUP BY employee_id) l
  ON h.employee_id = l.employee_id AND h.inserted_at = l.m""")
def q_agg_last_row(t):
    """AGG-6 / JOIN-12: rows at the latest inserted_at per employee (ties kept)."""
    h = t["employee_job_history"]
    last = h.groupBy("employee_id").agg(F.max("inserted_at").alias("inserted_at"))
    return h.join(last, ["employee_id", "inserted_at"]).select("id", "employee_id", "inserted_at")


@query("agg_string", f"""WITH wh AS ({_hours_rows_sql(2000, False)})
SELECT id, string_agg(source, ' | ' ORDER BY source) AS sources FROM wh GROUP BY id""")
def q_agg_string(t):
    """AGG-7: STRING_AGG of sources per person (sorted for determinism)."""
    rows = H.workforce_hours(conform(t["workforce_map"], "workforce_map"), conform(t["employees"], "employees"),
                             t["employee_hours"], conform(t["employee_job_titles"], "employee_job_titles"),
                             conform(t["contractor_job_hours"], "contractor_job_hours"),
                             conform(t["learner_job_hours"], "learner_job_hours"),
                             conform(t["volunteer_job_hours"], "volunteer_job_hours"), P2000)
    return H.sources_text(rows, "sources")


@query("agg_distinct", "SELECT DISTINCT department_id, department FROM fx_worker_staging")
def q_agg_distinct(t):
    """AGG-8: SELECT DISTINCT."""
    return t["worker_staging"].select("department_id", "department").distinct()


@query("agg_expr_group", "SELECT concat_ws(' ', first_name, last_name) AS name, COUNT(*) AS n FROM fx_network_users GROUP BY 1")
def q_agg_expr_group(t):
    """AGG-9: GROUP BY an expression."""
    return t["network_users"].groupBy(F.concat_ws(" ", "first_name", "last_name").alias("name")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("agg_two_stage", f"""SELECT COUNT(*) * 8 AS count FROM (SELECT date FROM fx_employee_hours
WHERE {sql_in_year('date', 2000)} GROUP BY date HAVING COUNT(date) > 5 AND date <= {TS})""")
def q_agg_two_stage(t):
    """AGG-10 / VW-k: 8 x number of dates with more than n hour rows."""
    return H.workday_hours(t["employee_hours"], P2000, 5)


def _hours_union(t, dedupe: bool):
    return H.workforce_hours(conform(t["workforce_map"], "workforce_map"), conform(t["employees"], "employees"),
                             t["employee_hours"], conform(t["employee_job_titles"], "employee_job_titles"),
                             conform(t["contractor_job_hours"], "contractor_job_hours"),
                             conform(t["learner_job_hours"], "learner_job_hours"),
                             conform(t["volunteer_job_hours"], "volunteer_job_hours"),
                             Params(reporting_year=2024, dedupe_hours=dedupe))


@query("hours_union", _hours_rows_sql(2024, False))
def q_hours_union(t):
    """SET-1: hour rows of the four sources (all rows kept)."""
    return _hours_union(t, False)


@query("hours_union_distinct", _hours_rows_sql(2024, True))
def q_hours_union_distinct(t):
    """SET-1 as the reference's UNION (equal rows of one person collapse)."""
    return _hours_union(t, True)


# ------------------------------------------------------------------ functions
@query("fn_title_case", """SELECT id, concat(upper(substr(first_name, 1, 1)), lower(substr(first_name, 2))) AS first_name_tc,
  concat(upper(substr(common_name, 1, 1)), lower(substr(common_name, 2, strpos(common_name, ' ') - 1)), 'Name',
         substr(common_name, strpos(common_name, ' ') + 5)) AS common_name_tc
FROM fx_network_users""")
def q_fn_title_case(t):
    """SCA-3: Python title case (not initcap)."""
    return t["network_users"].select("id", title_case("first_name").alias("first_name_tc"),
                                     title_case("common_name").alias("common_name_tc"))


@query("fn_concat", "SELECT id, concat(legal_first_name, ' ', legal_middle_name, ' ', legal_last_name) AS name FROM fx_employees")
def q_fn_concat(t):
    """SCA-5: T-SQL CONCAT (NULL as empty)."""
    return t["employees"].select("id", tsql_concat("legal_first_name", F.lit(" "), "legal_middle_name", F.lit(" "),
                                                   "legal_last_name").alias("name"))


@query("fn_concat_ws", "SELECT id, concat_ws(' ', legal_first_name, left(legal_middle_name, 1), legal_last_name) AS full_name FROM fx_employees")
def q_fn_concat_ws(t):
    """SCA-6 / SCA-8: CONCAT_WS with LEFT(middle, 1)."""
    return t["employees"].select("id", full_name_with_initial("legal_first_name", "legal_middle_name",
                                                              "legal_last_name").alias("full_name"))


@query("fn_name_split", """SELECT user_id,
  CASE WHEN strpos(name, ',') > 0 THEN lower(trim(substr(name, strpos(name, ',') + 1))) END AS first_name,
  CASE WHEN strpos(name, ',') > 0 THEN lower(left(name, strpos(name, ',') - 1)) END AS last_name
FROM fx_ehr_users""")
def q_fn_name_split(t):
    """SCA-7: "Last, First" split with instr / substring / left."""
    first, last = name_last_first("name")
    return t["ehr_users"].select("user_id", first.alias("first_name"), last.alias("last_name"))


@query("fn_duration", """SELECT DISTINCT time_duration,
  COALESCE(TRY_CAST(NULLIF(regexp_extract(time_duration, '^PT(?:([0-9]+)H)?(?:([0-9]+)M)?', 1), '') AS BIGINT), 0) * 60
  + COALESCE(TRY_CAST(NULLIF(regexp_extract(time_duration, '^PT(?:([0-9]+)H)?(?:([0-9]+)M)?', 2), '') AS BIGINT), 0) AS minutes
FROM fx_raw_timecards""")
def q_fn_duration(t):
    """SCA-9: distinct durations and their minutes."""
    return t["raw_timecards"].select("time_duration", iso_duration_minutes("time_duration").alias("minutes")).distinct()


@query("fn_datediff", """SELECT learner_id, start_date, end_date, CAST(date_diff('day', start_date, end_date) + 1 AS INTEGER) AS total_days,
  CAST(date_diff('day', CASE WHEN start_date < DATE '2024-01-01' THEN DATE '2024-01-01' ELSE start_date END,
                   CASE WHEN end_date > DATE '2024-12-31' THEN DATE '2024-12-31' ELSE end_date END) + 1 AS INTEGER) AS year_days
FROM fx_learner_job_hours""")
def q_fn_datediff(t):
    """SCA-11: DATEDIFF(DAY, a, b) = datediff(b, a)."""
    return t["learner_job_hours"].select(
        "learner_id", "start_date", "end_date",
        (F.datediff("end_date", "start_date") + 1).alias("total_days"),
        (F.datediff(clip_end("end_date", 2024), clip_start("start_date", 2024)) + 1).alias("year_days"))


@query("fn_date_format", "SELECT id, strftime(hire_date, '%Y-%m-%d') AS hire_date FROM fx_employees")
def q_fn_date_format(t):
    """SCA-16: FORMAT(d, 'yyyy-MM-dd')."""
    return t["employees"].select("id", F.date_format("hire_date", "yyyy-MM-dd").alias("hire_date"))


@query("fn_case", """SELECT m.id, CASE WHEN e.status = 'Terminated' OR nu.is_deleted THEN 'Terminated'
  WHEN e.status = 'Inactive' OR nu.is_disabled THEN 'Inactive' ELSE 'Active' END AS status
FROM fx_workforce_map m LEFT JOIN fx_network_users nu ON m.network_id = nu.id LEFT JOIN fx_employees e ON m.employee_id = e.id""")
def q_fn_case(t):
    """SCA-17 / VW-i: CASE status with NULL-aware fall-through."""
    nu = t["network_users"].select(F.col("id").alias("__nid"), "is_deleted", "is_disabled")
    e = t["employees"].select(F.col("id").alias("__eid"), "status")
    j = (t["workforce_map"].withColumns({"__n": spread_nulls("network_id"), "__e": spread_nulls("employee_id")})
         .join(nu, F.col("__n") == F.col("__nid"), "left").join(e, F.col("__e") == F.col("__eid"), "left"))
    return j.select("id", F.when((F.col("status") == "Terminated") | F.col("is_deleted"), "Terminated")
                    .when((F.col("status") == "Inactive") | F.col("is_disabled"), "Inactive")
                    .otherwise("Active").alias("status"))


@query("fn_round", f"""SELECT employee_id, {rnd('CAST(SUM(paid_minutes) AS DOUBLE) / (60 * 2080)')} AS fte
FROM fx_employee_hours GROUP BY employee_id""")
def q_fn_round(t):
    """SCA-19 / SCA-21: ROUND(x, 2) of a division, decimal HALF_UP in both engines."""
    return t["employee_hours"].groupBy("employee_id").agg(
        round2(F.sum("paid_minutes").cast("double") / (60 * 2080)).alias("fte"))


@query("fn_openjson", """SELECT id, 'ecw instance 1' AS source, unnest(CAST(json_extract(ecw_ids, '$."ecw instance 1"') AS VARCHAR[])) AS ecw_id
FROM fx_workforce_map""")
def q_fn_openjson(t):
    """SCA-22: OPENJSON(col, '$.key') as from_json + explode."""
    return AU.json_ids(t["workforce_map"], ("ecw instance 1",)).select("id", "source", "ecw_id")

