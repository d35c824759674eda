"""Run-log rows of the worker and timecard runs (SNK-2, DML-33, TC-9, D20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from staffline.operators import employees as E
from staffline.operators import timecards as TC
from staffline.operators.runlog import run_log_row
from staffline.plans.reconcile_q import AS_OF, TS, _emp_count_sql
from staffline.plans.registry import query
from staffline.plans.timecard_q import _CLASSIFIED, _DAILY, _daily, _rows


@query("run_log_workers", f"""
WITH c AS ({_emp_count_sql()})
SELECT CAST(NULL AS BIGINT) AS id, 'workers' AS query_type, {TS} AS logged_at,
  (SELECT COUNT(*) FROM fx_worker_staging) AS query_count, c.changed_reference AS update_count,
  (SELECT COUNT(*) FROM (SELECT aoid FROM fx_worker_staging EXCEPT SELECT aoid FROM fx_employees)) AS insert_count,
  CAST(NULL AS VARCHAR) AS failure_step, CAST(NULL AS VARCHAR) AS warnings, TRUE AS is_success
FROM c
""")
def q_run_log_workers(t):
    """SNK-2: log row of a worker run (snapshot size, changed, new), counted before the change."""
    w = t["worker_staging"]
    counts = (w.agg(F.count(F.lit(1)).alias("query_count"))
              .crossJoin(E.employee_change_count(w, t["employees"], t["employee_info"], t["employee_job_titles"]))
              .crossJoin(E.new_employee_count(t["employees"], w)))
    return run_log_row(counts, "workers", AS_OF, query_count="query_count", update_count="changed_reference",
                       insert_count="new_employees")


@query("run_log_timecards", f"""
WITH d AS ({_DAILY}),
c AS (SELECT COUNT(CASE WHEN d.work_minutes != h.work_minutes OR d.paid_minutes != h.paid_minutes
                         OR d.regular_minutes != h.regular_minutes THEN 1 END) AS changed_reference
      FROM d JOIN fx_employee_hours h ON d.employee_id = h.employee_id AND d.date = h.date),
u AS (SELECT string_agg(DISTINCT pay_code, ', ' ORDER BY pay_code) AS codes FROM ({_CLASSIFIED}) WHERE unmapped)
SELECT CAST(NULL AS BIGINT) AS id, 'timecards' AS query_type, {TS} AS logged_at,
  (SELECT COUNT(*) FROM d) AS query_count, c.changed_reference AS update_count,
  (SELECT COUNT(*) FROM d LEFT JOIN fx_employee_hours h ON d.employee_id = h.employee_id AND d.date = h.date
   WHERE h.employee_id IS NULL) AS insert_count,
  CAST(NULL AS VARCHAR) AS failure_step,
  CASE WHEN u.codes IS NOT NULL THEN concat('Unmapped paycodes: ', u.codes) END AS warnings, TRUE AS is_success
FROM c CROSS JOIN u
""")
def q_run_log_timecards(t):
    """SNK-2 / TC-9: log row of a timecard run; unmapped pay codes go to ``warnings``, not failure."""
    counts = TC.run_counts(_daily(t), t["employee_hours"]).crossJoin(TC.paycode_warning(TC.classify_minutes(_rows(t))))
    return run_log_row(counts, "timecards", AS_OF, query_count="query_count", update_count="changed_reference",
                       insert_count="inserted", warnings="warnings")
