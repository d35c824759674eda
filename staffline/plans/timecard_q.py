"""Query keys of timecards -> employee_hours."""

from __future__ import annotations

from pyspark.sql import functions as F

from staffline.operators import timecards as TC
from staffline.params import PAID_EXTRA_CODES, REGULAR_CODES, UNPAID_CODES, WORK_EXTRA_CODES
from staffline.plans.reconcile_q import AS_OF, TS
from staffline.plans.registry import query
from staffline.sources import documents as DOC


def _in(codes) -> str:
    return "(" + ", ".join("'" + c + "'" for c in codes) + ")"


_REG = _in(REGULAR_CODES)
_WORK = _in(REGULAR_CODES + WORK_EXTRA_CODES)
_PAID = _in(REGULAR_CODES + WORK_EXTRA_CODES + PAID_EXTRA_CODES)
_KNOWN = _in(REGULAR_CODES + WORK_EXTRA_CODES + PAID_EXTRA_CODES + UNPAID_CODES)
_PAT = "'^PT(?:([0-9]+)H)?(?:([0-9]+)M)?'"
_MIN = (f"(COALESCE(TRY_CAST(NULLIF(regexp_extract(time_duration, {_PAT}, 1), '') AS BIGINT), 0) * 60 + "
        f"COALESCE(TRY_CAST(NULLIF(regexp_extract(time_duration, {_PAT}, 2), '') AS BIGINT), 0))")

_CLASSIFIED = f"""SELECT associate_oid, period_start, entry_date, pay_code, time_duration, {_MIN} AS minutes,
  CASE WHEN pay_code IN {_REG} THEN {_MIN} ELSE 0 END AS regular_minutes,
  CASE WHEN pay_code IN {_WORK} THEN {_MIN} ELSE 0 END AS work_minutes,
  CASE WHEN pay_code IN {_PAID} THEN {_MIN} ELSE 0 END AS paid_minutes,
  NOT COALESCE(pay_code IN {_KNOWN}, FALSE) AS unmapped
FROM fx_raw_timecards WHERE entry_date IS NOT NULL"""

_ELIGIBLE = f"""SELECT id, aoid, job_title_id FROM fx_employees
WHERE status <> 'Terminated' OR CAST(termination_date AS TIMESTAMP) >= {TS} - INTERVAL 1 MONTH"""

_LOOKED_UP = f"""SELECT c.*, el.id AS employee_id, el.job_title_id FROM ({_CLASSIFIED}) c
JOIN (SELECT * FROM ({_ELIGIBLE}) WHERE aoid IS NOT NULL QUALIFY ROW_NUMBER() OVER (PARTITION BY aoid ORDER BY id) = 1) el
  ON c.associate_oid = el.aoid"""

_DAILY = f"""SELECT employee_id, job_title_id, period_start, entry_date AS date,
  CAST(SUM(work_minutes) AS BIGINT) AS work_minutes, CAST(SUM(paid_minutes) AS BIGINT) AS paid_minutes,
  CAST(SUM(regular_minutes) AS BIGINT) AS regular_minutes
FROM ({_LOOKED_UP})
WHERE employee_id IS NOT NULL AND job_title_id IS NOT NULL AND period_start IS NOT NULL AND entry_date IS NOT NULL
GROUP BY employee_id, job_title_id, period_start, entry_date"""


def _rows(t):
    return t["raw_timecards"].filter(F.col("entry_date").isNotNull())


def _daily(t):
    return TC.daily_minutes_prereduced(TC.classify_minutes(_rows(t)), TC.eligible_employees(t["employees"], AS_OF))


@query("timecard_flatten", """
SELECT associate_oid, period_start, entry_date, pay_code, lower(pay_code) AS pay_code_name, time_duration
FROM fx_raw_timecards WHERE entry_date IS NOT NULL
""")
def q_timecard_flatten(t):
    """SRC-2 / TC-2 / TC-3: timecard JSON documents -> daily-total rows with an entry date."""
    docs = DOC.parse(DOC.timecard_documents_from_tables(t["lineitem"], t["orders"]), "doc", DOC.TIMECARD_SCHEMA)
    return TC.flatten_timecards(docs)


@query("duration_minutes", f"SELECT associate_oid, entry_date, pay_code, time_duration, {_MIN} AS minutes FROM fx_raw_timecards")
def q_duration_minutes(t):
    """TC-5 / SCA-9: ISO-8601 duration text to minutes (prefix match, else 0)."""
    from staffline.functions import iso_duration_minutes
    return t["raw_timecards"].select("associate_oid", "entry_date", "pay_code", "time_duration",
                                     iso_duration_minutes("time_duration").alias("minutes"))


@query("paycode_minutes", _CLASSIFIED)
def q_paycode_minutes(t):
    """TC-6..8: regular, work and paid minutes by pay code."""
    return TC.classify_minutes(_rows(t)).drop("pay_code_name")


@query("unmapped_paycodes", f"""
SELECT pay_code, COUNT(*) AS rows, CAST(SUM(minutes) AS BIGINT) AS minutes FROM ({_CLASSIFIED}) WHERE unmapped GROUP BY pay_code
""")
def q_unmapped_paycodes(t):
    """TC-9: pay codes in no list (paid as 0; reported, the run goes on)."""
    return TC.unmapped_paycodes(TC.classify_minutes(_rows(t))).withColumn("minutes", F.col("minutes").cast("long"))


@query("eligible_employees", _ELIGIBLE)
def q_eligible_employees(t):
    """TC-1: employees whose timecards are pulled."""
    return TC.eligible_employees(t["employees"], AS_OF)


@query("timecard_lookup", _LOOKED_UP)
def q_timecard_lookup(t):
    """TC-4: employee id and current title attached by aoid."""
    return TC.lookup_employees(TC.classify_minutes(_rows(t)), TC.eligible_employees(t["employees"], AS_OF))


@query("daily_minutes", _DAILY)
def q_daily_minutes(t):
    """TC-10: minutes per (employee, title, period, date)."""
    return _daily(t)


@query("tc_dates", f"""
SELECT DISTINCT period_start, date FROM ({_DAILY}) EXCEPT SELECT period_start, date FROM fx_timecard_dates
""")
def q_tc_dates(t):
    """DML-12: timecard dates not stored yet."""
    return TC.new_timecard_dates(_daily(t), t["timecard_dates"])


@query("hours_change_count", f"""
SELECT COUNT(CASE WHEN d.work_minutes != h.work_minutes OR d.paid_minutes != h.paid_minutes
                    OR d.regular_minutes != h.regular_minutes THEN 1 END) AS changed_reference,
       COUNT(CASE WHEN d.work_minutes IS DISTINCT FROM h.work_minutes OR d.paid_minutes IS DISTINCT FROM h.paid_minutes
                    OR d.regular_minutes IS DISTINCT FROM h.regular_minutes THEN 1 END) AS changed
FROM ({_DAILY}) d JOIN fx_employee_hours h ON d.employee_id = h.employee_id AND d.date = h.date
""")
def q_hours_change_count(t):
    """DML-14: matched days whose minutes changed."""
    return TC.hours_change_count(_daily(t), t["employee_hours"])


_PER_DAY = f"""SELECT employee_id, date, CAST(SUM(work_minutes) AS BIGINT) AS work_minutes,
  CAST(SUM(paid_minutes) AS BIGINT) AS paid_minutes, CAST(SUM(regular_minutes) AS BIGINT) AS regular_minutes,
  first(job_title_id ORDER BY period_start DESC, job_title_id ASC) AS job_title_id
FROM ({_DAILY}) GROUP BY employee_id, date"""

_UPDATED = """SELECT CAST(NULL AS BIGINT) AS id, h.employee_id, h.job_title_id, h.date,
  CASE WHEN p.employee_id IS NOT NULL THEN p.work_minutes ELSE h.work_minutes END AS work_minutes,
  CASE WHEN p.employee_id IS NOT NULL THEN p.paid_minutes ELSE h.paid_minutes END AS paid_minutes,
  CASE WHEN p.employee_id IS NOT NULL THEN p.regular_minutes ELSE h.regular_minutes END AS regular_minutes
FROM fx_employee_hours h LEFT JOIN pd p ON h.employee_id = p.employee_id AND h.date = p.date"""

_CONTAINING = """SELECT x.employee_id, x.date, j.id AS history_id, j.job_title_id AS history_job_title_id
FROM {src} x JOIN fx_job_history j ON x.employee_id = j.employee_id
  AND x.date BETWEEN j.start_date AND COALESCE(j.end_date, DATE '2099-12-31')
QUALIFY ROW_NUMBER() OVER (PARTITION BY x.employee_id, x.date ORDER BY j.start_date DESC, j.id DESC) = 1"""

_RETITLED = """SELECT r.id, r.employee_id,
  CASE WHEN c.history_job_title_id IS NOT NULL AND c.history_job_title_id != r.job_title_id
       THEN c.history_job_title_id ELSE r.job_title_id END AS job_title_id,
  r.date, r.work_minutes, r.paid_minutes, r.regular_minutes
FROM {src} r LEFT JOIN ({containing}) c ON r.employee_id = c.employee_id AND r.date = c.date"""


@query("history_range_join", _CONTAINING.format(src="fx_employee_hours"))
def q_history_range_join(t):
    """JOIN-10: the history interval containing each hours row (equi on employee + range)."""
    return TC.containing_interval(t["employee_hours"], t["employee_job_history"])


@query("hours_retitle", _RETITLED.format(
    src="(SELECT CAST(NULL AS BIGINT) AS id, * FROM fx_employee_hours)",
    containing=_CONTAINING.format(src="fx_employee_hours")))
def q_hours_retitle(t):
    """DML-16: hours rows take the title of the containing history interval."""
    return TC.retitle_hours(t["employee_hours"], t["employee_job_history"])


@query("hours_upsert", f"""
WITH pd AS ({_PER_DAY}),
upd AS ({_UPDATED}),
ret AS ({_RETITLED.format(src='upd', containing=_CONTAINING.format(src='upd'))})
SELECT * FROM ret
UNION ALL
SELECT ROW_NUMBER() OVER (ORDER BY p.employee_id, p.date) AS id, p.employee_id, p.job_title_id, p.date,
       p.work_minutes, p.paid_minutes, p.regular_minutes
FROM pd p WHERE NOT EXISTS (SELECT 1 FROM fx_employee_hours h WHERE h.employee_id = p.employee_id AND h.date = p.date)
""")
def q_hours_upsert(t):
    """DML-15..17: update matched days, re-title by history, insert new days."""
    return TC.upsert_hours(t["employee_hours"], _daily(t), t["employee_job_history"])
