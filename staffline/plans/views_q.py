"""Query keys of the reporting views (VW-1 .. VW-7)."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from staffline.operators import views as V
from staffline.params import Params
from staffline.plans.oracle import in_year, rnd
from staffline.plans.registry import query

P2000 = Params(reporting_year=2000)
P2024 = Params(reporting_year=2024, as_of=dt.datetime(2024, 12, 31, 12, 0, 0))
# At sf0.01 no date has 600 hour rows; the fixture note uses 5.
WORKDAY_MIN_ROWS = 5

_NAME = "concat_ws(' ', {p}.legal_first_name, left({p}.legal_middle_name, 1), {p}.legal_last_name)"

VIEW_EMPLOYEES_SQL = f"""
WITH cur AS (SELECT employee_id, SUM(paid_minutes) AS pm FROM fx_employee_hours
             WHERE {in_year('date', 2000)} GROUP BY employee_id),
     prev AS (SELECT employee_id, SUM(paid_minutes) AS pm FROM fx_employee_hours
              WHERE {in_year('date', 1999)} GROUP BY employee_id)
SELECT m.id AS id, e.id AS employee_id, {_NAME.format(p='e')} AS full_name, e.work_email,
       COALESCE(l.epic_location, l.location) AS location, d.name AS department,
       t.job_title, t.uds_line, t.hcai_line, t.has_clinical_admin_time, e.status,
       CAST(NULL AS VARCHAR) AS employment_type, e.hire_date, CAST(NULL AS DATE) AS start_date,
       e.termination_date,
       {rnd('CAST(cur.pm AS DOUBLE) / 60')} AS current_year_hours,
       {rnd('CAST(cur.pm AS DOUBLE) / (60 * 2080)')} AS current_year_fte,
       {rnd('CAST(prev.pm AS DOUBLE) / (60 * 2080)')} AS previous_year_fte,
       CAST(NULL AS DECIMAL(6,2)) AS hired_fte,
       {_NAME.format(p='mg')} AS manager, e.is_manager
FROM fx_employees e
  LEFT JOIN fx_workforce_map m ON e.id = m.employee_id
  LEFT JOIN fx_employees mg ON e.reports_to_id = mg.id
  LEFT JOIN fx_departments d ON e.department_id = d.id
  LEFT JOIN fx_locations l ON e.location_id = l.id
  LEFT JOIN fx_job_titles t ON e.job_title_id = t.id
  LEFT JOIN cur ON e.id = cur.employee_id
  LEFT JOIN prev ON e.id = prev.employee_id
"""


@query("view_employees", VIEW_EMPLOYEES_SQL)
def q_view_employees(t):
    """VW-3: employee profile, this/last year FTE, manager name."""
    return V.view_employees(t, P2000)


VIEW_JOB_HISTORY_SQL = f"""
SELECT m.id AS id, e.id AS employee_id, {_NAME.format(p='e')} AS full_name, h.job_title_id,
       t.job_title, t.uds_line, t.hcai_line, h.start_date, h.end_date, e.status, h.inserted_at
FROM fx_employees e
  LEFT JOIN fx_workforce_map m ON e.id = m.employee_id
  INNER JOIN fx_job_history h ON e.id = h.employee_id
  INNER JOIN fx_job_titles t ON h.job_title_id = t.id
"""


@query("view_job_history", VIEW_JOB_HISTORY_SQL)
def q_view_job_history(t):
    """VW-4: job history with titles."""
    return V.view_job_history(t)


def _pooled(col: str, idcol: str) -> str:
    return f"CASE WHEN {idcol} = 24 THEN {col} / 5.0 WHEN {idcol} = 23 THEN {col} / 4.0 ELSE {col} END"


VIEW_CONTRACTORS_SQL = f"""
WITH dates AS (SELECT contractor_id, MIN(start_date) AS start_date, MAX(end_date) AS end_date
               FROM fx_contractor_job_hours GROUP BY contractor_id),
     cur AS (SELECT contractor_id, CAST(SUM(hours) AS DOUBLE) AS h FROM fx_contractor_job_hours
             WHERE {in_year('start_date', 2000)} GROUP BY contractor_id),
     prev AS (SELECT contractor_id, CAST(SUM(hours) AS DOUBLE) AS h FROM fx_contractor_job_hours
              WHERE {in_year('start_date', 1999)} GROUP BY contractor_id)
SELECT m.id AS id, c.id AS contractor_id, concat_ws(' ', c.first_name, c.last_name) AS contractor,
       nu.common_name AS full_name,
       COALESCE(nu.primary_email, nu.email, nu.network_email, c.email) AS email,
       CAST(NULL AS VARCHAR) AS vendor, c.job_title, CAST(NULL AS VARCHAR) AS uds_line,
       CAST(NULL AS VARCHAR) AS hcai_line, dates.start_date, dates.end_date,
       {rnd(_pooled('cur.h', 'cur.contractor_id'))} AS current_year_hours,
       {rnd(_pooled('cur.h / 2080.0', 'cur.contractor_id'))} AS current_year_fte,
       {rnd(_pooled('prev.h / 2080.0', 'prev.contractor_id'))} AS previous_year_fte
FROM fx_contractors c
  LEFT JOIN fx_workforce_map m ON c.id = m.contractor_id
  LEFT JOIN fx_network_users nu ON m.network_id = nu.id
  LEFT JOIN dates ON c.id = dates.contractor_id
  LEFT JOIN cur ON c.id = cur.contractor_id
  LEFT JOIN prev ON c.id = prev.contractor_id
"""


@query("view_contractors", VIEW_CONTRACTORS_SQL)
def q_view_contractors(t):
    """VW-5: contractor profile, dates, pooled hours / FTE."""
    return V.view_contractors(t, P2000)


_CLIP_S = "CASE WHEN h.start_date < DATE '2024-01-01' THEN DATE '2024-01-01' ELSE h.start_date END"
_CLIP_E = "CASE WHEN h.end_date > DATE '2024-12-31' THEN DATE '2024-12-31' ELSE h.end_date END"
_OK = ("(h.end_date >= DATE '2024-01-01' AND h.start_date <= DATE '2024-12-31' "
       "AND COALESCE(h.hours, 0) > 0)")
_FRAC = (f"CAST(date_diff('day', {_CLIP_S}, {_CLIP_E}) + 1 AS DOUBLE) / "
         "CAST(date_diff('day', h.start_date, h.end_date) + 1 AS DOUBLE)")
_LHOURS = f"CASE WHEN {_OK} THEN {rnd(_FRAC + ' * CAST(COALESCE(h.hours, 0) AS DOUBLE)')} END"

VIEW_LEARNERS_SQL = f"""
SELECT m.id AS id, l.id AS learner_id, concat_ws(' ', l.first_name, l.last_name) AS full_name,
       COALESCE(nu.primary_email, nu.email, nu.network_email, l.email) AS email,
       l.job_title, CAST(NULL AS VARCHAR) AS site, CAST(NULL AS VARCHAR) AS supervisor,
       CAST(NULL AS VARCHAR) AS uds_line, CAST(NULL AS VARCHAR) AS hcai_line,
       h.start_date, h.end_date, CAST(NULL AS VARCHAR) AS pre_graduate,
       CAST(NULL AS VARCHAR) AS post_graduate, CAST(NULL AS VARCHAR) AS workforce_role,
       CASE WHEN {_OK} THEN {_CLIP_S} END AS adjusted_start_date,
       CASE WHEN {_OK} THEN {_CLIP_E} END AS adjusted_end_date,
       {_LHOURS} AS current_year_hours,
       {rnd(_LHOURS + ' / 2080.0')} AS current_year_fte
FROM fx_learners l
  LEFT JOIN fx_workforce_map m ON l.id = m.learner_id
  LEFT JOIN fx_network_users nu ON m.network_id = nu.id
  LEFT JOIN fx_learner_job_hours h ON l.id = h.learner_id
"""


@query("view_learners", VIEW_LEARNERS_SQL)
def q_view_learners(t):
    """VW-6: learner x hour row with prorated current-year hours (2024)."""
    return V.view_learners(t, P2024)


VIEW_VOLUNTEERS_SQL = f"""
SELECT m.id AS id, v.id AS volunteer_id, concat_ws(' ', v.first_name, v.last_name) AS full_name,
       COALESCE(nu.primary_email, nu.email, nu.network_email, v.email) AS email,
       v.job_title, CAST(NULL AS VARCHAR) AS supervisor, v.is_event_only,
       CAST(NULL AS VARCHAR) AS uds_line, CAST(NULL AS VARCHAR) AS hcai_line,
       h.start_date, h.end_date, CAST(NULL AS VARCHAR) AS pre_graduate,
       CAST(NULL AS VARCHAR) AS post_graduate, CAST(NULL AS VARCHAR) AS workforce_role,
       CASE WHEN {_OK} THEN CAST(h.hours AS DOUBLE) END AS current_year_hours,
       CASE WHEN {_OK} THEN {rnd('CAST(h.hours AS DOUBLE) / 2080.0')} END AS current_year_fte
FROM fx_volunteers v
  LEFT JOIN fx_workforce_map m ON v.id = m.volunteer_id
  LEFT JOIN fx_network_users nu ON m.network_id = nu.id
  LEFT JOIN fx_volunteer_job_hours h ON v.id = h.volunteer_id AND v.job_title = h.job_title
"""


@query("view_volunteers", VIEW_VOLUNTEERS_SQL)
def q_view_volunteers(t):
    """VW-7: volunteer x hour row with current-year hours (2024)."""
    return V.view_volunteers(t, P2024)


def _hours_rows_sql(year: int, dedupe: bool) -> str:
    """(id, source, hours) of every mapped person, as the reference's UNION."""
    ys, ye = f"DATE '{year}-01-01'", f"DATE '{year}-12-31'"
    clip_s = f"CASE WHEN h.start_date < {ys} THEN {ys} ELSE h.start_date END"
    clip_e = f"CASE WHEN h.end_date > {ye} THEN {ye} ELSE h.end_date END"
    frac = (f"CAST(date_diff('day', {clip_s}, {clip_e}) + 1 AS DOUBLE) / "
            "CAST(date_diff('day', h.start_date, h.end_date) + 1 AS DOUBLE)")
    union = "UNION" if dedupe else "UNION ALL"
    return f"""
  SELECT m.id, 'Employee' AS source, CAST(SUM(eh.paid_minutes) AS DOUBLE) / 60.0 AS hours
  FROM fx_workforce_map m JOIN fx_employees e ON m.employee_id = e.id
    JOIN fx_employee_hours eh ON e.id = eh.employee_id JOIN fx_job_titles t ON e.job_title_id = t.id
  WHERE {in_year('eh.date', year)} GROUP BY m.id
  {union}
  SELECT m.id, 'Contractor', {_pooled('ch.hours', 'ch.contractor_id')}
  FROM fx_workforce_map m JOIN (SELECT contractor_id, CAST(SUM(hours) AS DOUBLE) AS hours
    FROM fx_contractor_job_hours WHERE {in_year('start_date', year)} GROUP BY contractor_id) ch
    ON m.contractor_id = ch.contractor_id
  {union}
  SELECT m.id, 'Learner', {rnd(frac + ' * CAST(h.hours AS DOUBLE)')}
  FROM fx_workforce_map m JOIN fx_learner_job_hours h ON m.learner_id = h.learner_id
  WHERE h.end_date >= {ys} AND h.start_date <= {ye} AND h.hours > 0
  {union}
  SELECT m.id, 'Volunteer', CAST(h.hours AS DOUBLE)
  FROM fx_workforce_map m JOIN fx_volunteer_job_hours h ON m.volunteer_id = h.volunteer_id
  WHERE h.end_date >= {ys} AND h.start_date <= {ye} AND h.hours > 0"""


def view_people_sql(year: int, dedupe: bool = False) -> str:
    return f"""
WITH wh AS ({_hours_rows_sql(year, dedupe)}),
ftes AS (SELECT id, string_agg(source, ' | ' ORDER BY source) AS src, SUM(hours) AS h FROM wh GROUP BY id),
cd AS (SELECT contractor_id, job_title, MIN(start_date) AS s FROM fx_contractor_job_hours GROUP BY 1, 2),
ld AS (SELECT learner_id, job_title, MIN(start_date) AS s FROM fx_learner_job_hours GROUP BY 1, 2),
vd AS (SELECT volunteer_id, job_title, MIN(start_date) AS s FROM fx_volunteer_job_hours GROUP BY 1, 2)
SELECT m.id, m.network_id, m.employee_id, m.contractor_id, m.learner_id, m.volunteer_id,
  COALESCE(ftes.src, CASE WHEN m.employee_id IS NOT NULL THEN 'Employee'
    WHEN m.contractor_id IS NOT NULL THEN 'Contractor' WHEN m.learner_id IS NOT NULL THEN 'Learner'
    WHEN m.volunteer_id IS NOT NULL THEN 'Volunteer' END) AS staff_type,
  CASE WHEN m.employee_id IS NOT NULL THEN concat(e.legal_first_name, ' ', e.legal_last_name)
    WHEN nu.common_name LIKE '% %' AND NOT regexp_matches(nu.common_name, '[0-9]') THEN nu.common_name
    WHEN m.contractor_id IS NOT NULL THEN concat(c.first_name, ' ', c.last_name)
    WHEN m.learner_id IS NOT NULL THEN concat(l.first_name, ' ', l.last_name)
    WHEN m.volunteer_id IS NOT NULL THEN concat(v.first_name, ' ', v.last_name) END AS staff_name,
  COALESCE(nu.primary_email, nu.email, nu.network_email, e.work_email, c.email, l.email, v.email) AS email,
  COALESCE(t.job_title, c.job_title, l.job_title, v.job_title, nu.job_title) AS job_title,
  COALESCE(t.uds_line, CAST(NULL AS VARCHAR)) AS current_uds_line,
  COALESCE(t.hcai_line, CAST(NULL AS VARCHAR)) AS current_hcai_line,
  CASE WHEN e.status = 'Terminated' OR nu.is_deleted THEN 'Terminated'
       WHEN e.status = 'Inactive' OR nu.is_disabled THEN 'Inactive' ELSE 'Active' END AS status,
  strftime(COALESCE(CAST(e.hire_date AS TIMESTAMP), nu.created_at, CAST(cd.s AS TIMESTAMP),
    CAST(ld.s AS TIMESTAMP), CAST(vd.s AS TIMESTAMP)), '%Y-%m-%d') AS start_date,
  strftime(CAST(e.termination_date AS TIMESTAMP), '%Y-%m-%d') AS end_date,
  CAST(m.epic_id AS VARCHAR) AS epic_user_id, cp.prov_id AS epic_prov_id, m.ecw_ids,
  {rnd('ftes.h')} AS calendar_year_hours, {rnd('ftes.h / 2080')} AS calendar_year_ftes
FROM fx_workforce_map m
  LEFT JOIN fx_network_users nu ON m.network_id = nu.id
  LEFT JOIN ftes ON m.id = ftes.id
  LEFT JOIN fx_employees e ON m.employee_id = e.id
  LEFT JOIN fx_job_titles t ON e.job_title_id = t.id
  LEFT JOIN fx_contractors c ON m.contractor_id = c.id
  LEFT JOIN cd ON c.id = cd.contractor_id AND c.job_title = cd.job_title
  LEFT JOIN fx_learners l ON m.learner_id = l.id
  LEFT JOIN ld ON l.id = ld.learner_id AND l.job_title = ld.job_title
  LEFT JOIN fx_volunteers v ON m.volunteer_id = v.id
  LEFT JOIN vd ON v.id = vd.volunteer_id AND v.job_title = vd.job_title
  LEFT JOIN fx_clinical_providers cp ON CAST(m.epic_id AS VARCHAR) = cp.user_id
"""


@query("view_people", view_people_sql(2000))
def q_view_people(t):
    """VW-1 for 2000 (employee and contractor hours)."""
    return V.view_people(t, P2000)


@query("view_people_y2024", view_people_sql(2024))
def q_view_people_y2024(t):
    """VW-1 for 2024 (learner and volunteer hours)."""
    return V.view_people(t, P2024)


@query("view_people_distinct", view_people_sql(2024, dedupe=True))
def q_view_people_distinct(t):
    """VW-1 for 2024 with the reference's UNION of hour rows (equal rows of one person collapse)."""
    return V.view_people(t, replace(P2024, dedupe_hours=True))


def _names_sql() -> str:
    return """
  SELECT m.id,
    CASE WHEN m.employee_id IS NOT NULL THEN concat(e.legal_first_name, ' ', e.legal_last_name)
      WHEN nu.common_name LIKE '% %' AND NOT regexp_matches(nu.common_name, '[0-9]') THEN nu.common_name
      WHEN m.contractor_id IS NOT NULL THEN concat(c.first_name, ' ', c.last_name)
      WHEN m.learner_id IS NOT NULL THEN concat(l.first_name, ' ', l.last_name)
      WHEN m.volunteer_id IS NOT NULL THEN concat(v.first_name, ' ', v.last_name) END AS full_name,
    COALESCE(nu.primary_email, nu.email, nu.network_email, e.work_email, c.email, l.email, v.email) AS email
  FROM fx_workforce_map m
    LEFT JOIN fx_network_users nu ON m.network_id = nu.id
    LEFT JOIN fx_employees e ON m.employee_id = e.id
    LEFT JOIN fx_contractors c ON m.contractor_id = c.id
    LEFT JOIN fx_learners l ON m.learner_id = l.id
    LEFT JOIN fx_volunteers v ON m.volunteer_id = v.id"""


def view_hours_sql(year: int, as_of: str, min_rows: int, dedupe: bool = False) -> str:
    ys, ye = f"DATE '{year}-01-01'", f"DATE '{year}-12-31'"
    clip_s = f"CASE WHEN h.start_date < {ys} THEN {ys} ELSE h.start_date END"
    clip_e = f"CASE WHEN h.end_date > {ye} THEN {ye} ELSE h.end_date END"
    frac = (f"CAST(date_diff('day', {clip_s}, {clip_e}) + 1 AS DOUBLE) / "
            "CAST(date_diff('day', h.start_date, h.end_date) + 1 AS DOUBLE)")
    union = "UNION" if dedupe else "UNION ALL"
    return f"""
WITH fte_dates AS (SELECT date FROM fx_employee_hours WHERE {in_year('date', year)}
                   GROUP BY date HAVING COUNT(date) > {min_rows} AND date <= TIMESTAMP '{as_of}'),
fte_hours AS (SELECT COUNT(*) * 8 AS count FROM fte_dates),
total AS (
  SELECT m.id, 'Employee' AS source, t.job_title, t.uds_line, t.hcai_line, MIN(eh.date) AS start_date,
         MAX(eh.date) AS end_date, CAST(SUM(eh.paid_minutes) AS DOUBLE) / 60.0 AS hours
  FROM fx_workforce_map m JOIN fx_employee_hours eh ON m.employee_id = eh.employee_id
    JOIN fx_job_titles t ON eh.job_title_id = t.id
  WHERE {in_year('eh.date', year)} GROUP BY m.id, t.job_title, t.uds_line, t.hcai_line
  {union}
  SELECT m.id, 'Contractor', ch.job_title, ch.uds_line, ch.hcai_line, ch.s, ch.e,
         {_pooled('ch.hours', 'ch.contractor_id')}
  FROM fx_workforce_map m JOIN (SELECT contractor_id, job_title, uds_line, hcai_line, MIN(start_date) AS s,
    MAX(end_date) AS e, CAST(SUM(hours) AS DOUBLE) AS hours FROM fx_contractor_job_hours
    WHERE {in_year('start_date', year)} GROUP BY contractor_id, job_title, uds_line, hcai_line) ch
    ON m.contractor_id = ch.contractor_id
  {union}
  SELECT m.id, 'Learner', h.job_title, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), {clip_s}, {clip_e},
         {rnd(frac + ' * CAST(h.hours AS DOUBLE)')}
  FROM fx_workforce_map m JOIN fx_learner_job_hours h ON m.learner_id = h.learner_id
  WHERE h.end_date >= {ys} AND h.start_date <= {ye} AND h.hours > 0
  {union}
  SELECT m.id, 'Volunteer', h.job_title, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), h.start_date, h.end_date,
         CAST(h.hours AS DOUBLE)
  FROM fx_workforce_map m JOIN fx_volunteer_job_hours h ON m.volunteer_id = h.volunteer_id
  WHERE h.end_date >= {ys} AND h.start_date <= {ye} AND h.hours > 0),
names AS ({_names_sql()})
SELECT names.id, names.full_name, names.email, total.source, total.job_title, total.uds_line, total.hcai_line,
  total.start_date, total.end_date,
  {rnd('total.hours')} AS current_calendar_year_hours,
  {rnd('total.hours / 2080')} AS current_calendar_year_fte,
  {rnd('total.hours / CAST(NULLIF(fte_hours.count, 0) AS DOUBLE)')} AS projected_eoy_fte
FROM names JOIN total ON names.id = total.id CROSS JOIN fte_hours
"""


@query("view_hours", view_hours_sql(2000, "2000-07-15 10:30:00", WORKDAY_MIN_ROWS))
def q_view_hours(t):
    """VW-2 for 2000 with projected FTE from workdays up to as_of."""
    return V.view_hours(t, P2000, min_rows=WORKDAY_MIN_ROWS)


@query("view_hours_y2024", view_hours_sql(2024, "2024-12-31 12:00:00", WORKDAY_MIN_ROWS))
def q_view_hours_y2024(t):
    """VW-2 for 2024 (learner and volunteer rows)."""
    return V.view_hours(t, P2024, min_rows=WORKDAY_MIN_ROWS)


@query("view_hours_distinct", view_hours_sql(2024, "2024-12-31 12:00:00", WORKDAY_MIN_ROWS, dedupe=True))
def q_view_hours_distinct(t):
    """VW-2 for 2024 with the reference's UNION of hour rows."""
    return V.view_hours(t, replace(P2024, dedupe_hours=True), min_rows=WORKDAY_MIN_ROWS)
