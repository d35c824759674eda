"""The four scheduled runs, each reading the newest committed tables under
``root`` and committing the next ones together (``sources.commits``).

* ``worker_run``: worker documents -> dimensions, employees, employee_info,
  job history (+ run log)
* ``timecard_run``: timecard documents -> timecard dates, employee_hours (+ run log)
* ``directory_run``: directory entries -> network_users (+ run log)
* ``linkage_run``: network_users / employees / analytics / EHR users -> workforce_map

Statement order inside a run follows the reference. Each table written by a
run is read back from storage by the later statements, which also bounds
lineage. Counts for the run log are taken before the change.
"""

from __future__ import annotations

import contextvars
import datetime as dt
import functools
import inspect

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffline.operators import accounts as A
from staffline.operators import dedupe as D
from staffline.operators import employees as EM
from staffline.operators import history as HI
from staffline.operators import linkage as LK
from staffline.operators import timecards as TC
from staffline.operators.flatten import flatten_directory, flatten_workers
from staffline.operators.reconcile import assign_ids
from staffline.operators.runlog import run_log_row
from staffline.schemas import conform
from staffline.session import cut_lineage
from staffline.sources.commits import Run, state
from staffline.sources.sinks import write_state

_STEPS: contextvars.ContextVar[list[str]] = contextvars.ContextVar("steps")
_RUN: contextvars.ContextVar[Run] = contextvars.ContextVar("run")


def _run() -> Run:
    return _RUN.get()


def _write(df: DataFrame, table: str) -> DataFrame:
    _step(f"write {table}")
    return _run().write(df, table)


def _log(row: DataFrame, root: str, run_id: str, job: str) -> None:
    """One run-log row per (job, run); a retried run replaces its own row."""
    write_state(row, f"{root}/run_log", f"{run_id}.{job}")


def _logged(job: str):
    """Run the job as one commit (``sources.commits``): its tables become visible together when it
    is through. The job returns its run-log row, or None. When a run ends in an error, a
    row with the failed step is written instead and the error goes on to the caller; the
    step is the last statement that began."""
    def deco(job_fn):
        @functools.wraps(job_fn)
        def inner(spark, *args, **kw):
            call = inspect.signature(job_fn).bind(spark, *args, **kw).arguments
            root, run_id = call["root"], call["run_id"]
            steps: list[str] = ["start"]
            token, run_token = _STEPS.set(steps), None
            try:
                with Run(spark, root, run_id, job, constraints=True) as run:
                    run_token = _RUN.set(run)
                    row = job_fn(spark, *args, **kw)
                    _step("check constraints and commit")
                    run.commit()
                    if row is not None:
                        _log(row, root, run_id, job)
            except Exception as ex:
                one = spark.range(1).select(F.lit(str(ex).split("\n")[0][:500]).alias("w"))
                as_of = call.get("as_of") or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
                _log(run_log_row(one, job, as_of, warnings="w", failure_step=steps[-1]), root, run_id, f"{job}.failed")
                raise
            finally:
                _STEPS.reset(token)
                if run_token is not None:
                    _RUN.reset(run_token)
        return inner
    return deco


def _step(name: str) -> None:
    _STEPS.get().append(name)


@_logged("workers")
def worker_run(spark: SparkSession, worker_pages: DataFrame, root: str, run_id: str, as_of: dt.datetime,
               initial: dict | None = None, mode: str = "failfast") -> None:
    init = initial or {}
    _step("flatten workers")
    if mode == "quarantine":
        workers, bad = flatten_workers(worker_pages, mode="quarantine")
        _write(bad.withColumn("errors", F.array_join("errors", ", ")), "worker_quarantine")
    else:
        workers = flatten_workers(worker_pages)
    workers = cut_lineage(workers)  # the staging table of the run
    st = {t: _run().read(t, init.get(t)) for t in
          ("departments", "locations", "employee_job_titles", "employees", "employee_info", "employee_job_history",
           "employee_hours", "workforce_map")}
    _write(EM.new_departments(workers, st["departments"]), "departments")
    _write(EM.new_locations(workers, st["locations"]), "locations")
    titles = _write(EM.new_job_titles(workers, st["employee_job_titles"], as_of), "employee_job_titles")
    counts = (workers.agg(F.count(F.lit(1)).alias("query_count"))
              .crossJoin(EM.employee_change_count(workers, st["employees"], st["employee_info"], titles))
              .crossJoin(EM.new_employee_count(st["employees"], workers)))
    log = run_log_row(counts, "workers", as_of, query_count="query_count", update_count="changed_reference",
                      insert_count="new_employees")
    log = cut_lineage(log)  # counts of the pre-state
    # Ids that change take their history, hours, map and info rows along (ON UPDATE CASCADE).
    _step("cascade employee ids")
    changes = cut_lineage(EM.employee_id_changes(st["employees"], workers, titles))
    kept = EM.cascade_employee_ids({t: conform(st[t], t) for t in
                                    ("employee_job_history", "employee_hours", "workforce_map", "employee_info")}, changes)
    emp, info = EM.upsert_employees(st["employees"], kept["employee_info"], workers, titles, as_of)
    emp = _write(emp, "employees")
    _write(info, "employee_info")
    if not changes.isEmpty():
        _write(kept["workforce_map"], "workforce_map")
        _step("write employee_hours")
        _run().write_parts(kept["employee_hours"].withColumn("month", TC.month_of("date")), "employee_hours", "month", None)
    _write(HI.update_history(kept["employee_job_history"], emp, as_of), "employee_job_history")
    return log


def _hours_to_update(daily: DataFrame, history: DataFrame) -> tuple[DataFrame, set | None, int | None]:
    """The stored hours that a pull can change, their months, and the greatest id of all hours.

    Those are the months of its days, of the days that the last pull inserted (they take the
    title of the history from the next run on) and of positions that changed since. All
    hours (no months) where that is not known: before the first pull, and after employee ids changed."""
    run = _run()
    entry, source = run.entry("employee_hours"), run.entry("employee_job_history")
    if "parts" not in entry or "history" not in entry:
        return run.read("employee_hours"), None, None
    months = {r.month for r in daily.select(TC.month_of("date")).distinct().collect()}  # one row a month
    months |= set(entry["fresh"])
    if source.get("path") != entry["history"]:
        before = spark_read(run, entry["history"]) if entry["history"] else history.limit(0)
        stored = [m for m in entry["parts"] if m[:1].isdigit()]
        if stored:
            changed = TC.months_of_changed_positions(before, history, min(stored), max(stored))
            months |= {r.month for r in changed.collect()}  # one row a month
    return run.read_parts("employee_hours", months), months, entry["max_id"]


def spark_read(run: Run, path: str) -> DataFrame:
    return run.spark.read.parquet(f"{run.root}/{path}")


def _write_hours(hours: DataFrame, touched: set | None, fresh: set, last_id: int | None) -> None:
    """Hours are kept in one part a month; a pull writes the touched ones."""
    run = _run()
    _step("write employee_hours")
    run.write_parts(hours.withColumn("month", TC.month_of("date")), "employee_hours", "month", touched)
    run.tables["employee_hours"] |= {
        "fresh": sorted(fresh), "history": run.entry("employee_job_history").get("path"),
        "max_id": max(last_id or 0, run.written("employee_hours").agg(F.max("id")).first()[0] or 0)}


@_logged("timecards")
def timecard_run(spark: SparkSession, timecard_docs: DataFrame, root: str, run_id: str, as_of: dt.datetime,
                 initial: dict | None = None) -> DataFrame:
    init = initial or {}
    st = {t: _run().read(t, init.get(t)) for t in ("employees", "employee_job_history", "timecard_dates")}
    _step("flatten timecards")
    rows = TC.classify_minutes(TC.flatten_timecards(timecard_docs))
    daily = cut_lineage(TC.daily_minutes_prereduced(rows, TC.eligible_employees(conform(st["employees"], "employees"),
                                                                                  as_of)))
    _step("find hours to update")
    hours, touched, last_id = _hours_to_update(daily, conform(st["employee_job_history"], "employee_job_history"))
    if touched is None:
        hours = _run().read("employee_hours", init.get("employee_hours"))
    counts = TC.run_counts(daily, hours).crossJoin(TC.paycode_warning(rows))
    log = cut_lineage(run_log_row(counts, "timecards", as_of, query_count="query_count",
                                  update_count="changed_reference", insert_count="inserted", warnings="warnings"))
    dates = st["timecard_dates"].select("period_start", "date").unionByName(
        TC.new_timecard_dates(daily, conform(st["timecard_dates"], "timecard_dates")))
    _write(dates, "timecard_dates")
    fresh = {r.month for r in daily.select(TC.month_of("date")).distinct().collect()}
    _write_hours(TC.upsert_hours(hours, daily, st["employee_job_history"], last_id), touched, fresh, last_id)
    return log


@_logged("directory")
def directory_run(spark: SparkSession, entries: DataFrame, root: str, run_id: str, as_of: dt.datetime,
                  initial: DataFrame | None = None, mode: str = "failfast",
                  max_deleted: float | None = A.MAX_DELETED) -> DataFrame:
    """``mode``: an entry that cannot be read ends the run, or ("quarantine") goes to the table
    ``directory_quarantine``. A run that would delete more than the share ``max_deleted`` of
    the accounts ends before it changes anything (None: no limit)."""
    users = _run().read("network_users", initial)
    _step("flatten directory")
    if mode == "quarantine":
        good, bad = flatten_directory(entries, mode="quarantine")
        snapshot = cut_lineage(good)
        _write(bad, "directory_quarantine")
    else:
        snapshot = cut_lineage(flatten_directory(entries))
    _step("check deletions")
    A.check_deletions(users, snapshot, max_deleted)
    counts = A.account_counts(users, snapshot)
    log = cut_lineage(run_log_row(counts, "directory", as_of, query_count="diff_rows",
                                  update_count="changed_reference", insert_count="inserted"))
    out = D.resolve_all(A.reconcile_accounts(users, snapshot, as_of))
    _write(out, "network_users")
    return log


@_logged("linkage")
def linkage_run(spark: SparkSession, root: str, run_id: str, analytics_users: DataFrame, ehr_users: DataFrame,
                initial_map: DataFrame | None = None) -> None:
    """Insert new account <-> employee links, then set analytics and EHR ids."""
    wm = conform(_run().read("workforce_map", initial_map), "workforce_map")
    users = _run().read("network_users")
    employees = _run().read("employees")
    _step("link employees")
    links = LK.link_employees(users, employees, wm)
    base = wm.agg(F.coalesce(F.max("id"), F.lit(0)).alias("__base"))
    new = assign_ids(links.crossJoin(F.broadcast(base)), ["network_id", "employee_id"], start_after=F.col("__base"))
    new = conform(new.drop("__base"), "workforce_map").select(*wm.columns)
    wm = cut_lineage(wm.unionByName(new))
    wm = cut_lineage(LK.link_analytics(analytics_users, users, wm))
    _write(LK.link_ehr(ehr_users, users, wm), "workforce_map")
