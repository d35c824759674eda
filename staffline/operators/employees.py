"""Worker snapshot -> dimensions, employees and employee_info.

``workers`` is the flattened HR snapshot (one row per worker, see
``operators.flatten.flatten_workers``). Every function returns the new state
of one table; ``upsert_employees`` chains them in the reference's order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffline.operators.ordering import first_by
from staffline.operators.reconcile import (anti_join, assign_ids, cascade_key, count_changed,
                                           join_update, snapshot_diff, soft_delete, sref)
from staffline.schemas import TABLES, conform

# Columns the employee update sets from the snapshot (``job_title_id`` comes
# from the title dimension's surrogate id).
EMPLOYEE_SET = ["id", "location_id", "department_id", "reports_to_id", "legal_first_name",
                "legal_middle_name", "legal_last_name", "preferred_first_name", "preferred_middle_name",
                "preferred_last_name", "gender", "pronouns", "work_email", "personal_email",
                "personal_mobile", "status", "employment_type", "hire_date", "start_date",
                "evaluation_date", "termination_date", "hired_fte", "is_manager"]
INFO_SET = ["id", "dob", "address_line_1", "address_line_2", "city", "state", "zip_code"]


def new_dimension(workers: DataFrame, dim: DataFrame, id_col: str, name_col: str, dim_name_col: str) -> DataFrame:
    """Insert (id, name) pairs whose id is new; one name per id (the smallest),
    so the primary key holds even when the snapshot disagrees with itself."""
    pairs = (workers.filter(F.col(id_col).isNotNull())
             .select(F.col(id_col).alias("id"), F.col(name_col).alias(dim_name_col)))
    new = anti_join(pairs, dim, "id").groupBy("id").agg(F.min(dim_name_col).alias(dim_name_col))
    return dim.unionByName(new, allowMissingColumns=True)


def new_departments(workers: DataFrame, departments: DataFrame) -> DataFrame:
    return new_dimension(workers, conform(departments, "departments").select("id", "name"),
                         "department_id", "department", "name")


def new_locations(workers: DataFrame, locations: DataFrame) -> DataFrame:
    return new_dimension(workers, conform(locations, "locations"), "location_id", "location", "location")


def new_job_titles(workers: DataFrame, titles: DataFrame, as_of: dt.datetime) -> DataFrame:
    """(job_title_id, job_title) pairs not yet known get the next surrogate ids."""
    t = conform(titles, "employee_job_titles")
    pairs = workers.filter(F.col("job_title_id").isNotNull() & F.col("job_title").isNotNull())
    new = snapshot_diff(pairs, t, ["job_title_id", "job_title"])
    base = t.agg(F.coalesce(F.max("id"), F.lit(0)).alias("__base"))
    new = assign_ids(new.crossJoin(F.broadcast(base)), ["job_title_id", "job_title"], start_after=F.col("__base"))
    new = new.select("id", "job_title_id", "job_title",
                     F.lit(as_of).cast("timestamp").alias("inserted_at"))
    return t.unionByName(new, allowMissingColumns=True)


def _with_title_key(workers: DataFrame, titles: DataFrame) -> DataFrame:
    """Workers whose (job_title_id, job_title) pair exists, with the title's surrogate id."""
    t = conform(titles, "employee_job_titles").select(
        F.col("id").alias("__title_id"), F.col("job_title_id").alias("__tid"), F.col("job_title").alias("__tname"))
    return workers.join(t, (F.col("job_title_id") == F.col("__tid")) & (F.col("job_title") == F.col("__tname")))


def _one_per_aoid(df: DataFrame, order: list | None = None) -> DataFrame:
    return first_by(df, ["aoid"], order or [("id", "asc")])


def _cols_or_null(df: DataFrame, table: str, cols: list[str], prefix: str = "") -> list:
    types = {f.name: f.dataType for f in TABLES[table].fields}
    return [(F.col(c) if c in df.columns else F.lit(None).cast(types[c])).alias(prefix + c) for c in cols]


def employee_change_count(workers: DataFrame, employees: DataFrame, employee_info: DataFrame,
                          titles: DataFrame) -> DataFrame:
    """Matched employees (aoid in employees, employee_info and a known title)
    with any difference in the 30 compared columns, counted both ways."""
    e_cols = EMPLOYEE_SET + ["job_title_id"]
    i_cols = INFO_SET[1:]
    w = _with_title_key(workers, titles).withColumn("job_title_id", F.col("__title_id"))
    src = w.select("aoid", *_cols_or_null(w, "employees", e_cols),
                   *_cols_or_null(w, "employee_info", i_cols, "info_"))
    target = (conform(employees, "employees").select("aoid", *e_cols)
              .join(conform(employee_info, "employee_info").select("aoid", *[F.col(c).alias(f"info_{c}") for c in i_cols]),
                    "aoid"))
    return count_changed(target, src, "aoid", e_cols + [f"info_{c}" for c in i_cols])


def update_employees(employees: DataFrame, workers: DataFrame, titles: DataFrame) -> DataFrame:
    """Every matched employee (by aoid) is overwritten from the snapshot,
    including ``id``; deleted employees are not undeleted."""
    emp = conform(employees, "employees")
    src = _one_per_aoid(conform(_with_title_key(workers, titles).withColumn("job_title_id", F.col("__title_id")),
                                "employees").select("aoid", "job_title_id", *EMPLOYEE_SET),
                        [("id", "asc"), ("job_title_id", "asc")])
    sets = {c: sref(c) for c in EMPLOYEE_SET + ["job_title_id"]}
    return join_update(emp, src, "aoid", sets)


def employee_id_changes(employees: DataFrame, workers: DataFrame, titles: DataFrame) -> DataFrame:
    """(old_id, new_id) of employees whose id the update changes."""
    emp = conform(employees, "employees").select("aoid", F.col("id").alias("old_id"))
    src = _one_per_aoid(_with_title_key(workers, titles).select("aoid", "id")).select("aoid", F.col("id").alias("new_id"))
    return emp.join(src, "aoid").filter(~F.col("old_id").eqNullSafe(F.col("new_id"))).select("old_id", "new_id")


def insert_employees(employees: DataFrame, workers: DataFrame, titles: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Snapshot workers with a known title whose aoid is new."""
    emp = conform(employees, "employees")
    new = anti_join(_with_title_key(workers, titles).withColumn("job_title_id", F.col("__title_id")), emp, "aoid")
    # A worker listed twice (or with two rows of one title) is inserted once, as the update takes one row.
    new = (_one_per_aoid(conform(new, "employees"), [("id", "asc"), ("job_title_id", "asc")])
           .withColumn("inserted_at", F.lit(as_of).cast("timestamp"))
           .withColumn("is_deleted", F.lit(False)).withColumn("deleted_at", F.lit(None).cast("timestamp")))
    return emp.unionByName(new.select(*emp.columns))


def new_employee_count(employees: DataFrame, workers: DataFrame) -> DataFrame:
    """``SELECT aoid FROM workers EXCEPT SELECT aoid FROM employees``, counted."""
    return snapshot_diff(workers, employees, ["aoid"]).agg(F.count(F.lit(1)).alias("new_employees"))


def upsert_employee_info(info: DataFrame, workers: DataFrame) -> DataFrame:
    """Update 7 columns of matched aoids, then insert new aoids."""
    inf = conform(info, "employee_info")
    src = _one_per_aoid(conform(workers, "employee_info").select("aoid", *INFO_SET))
    upd = join_update(inf, src, "aoid", {c: sref(c) for c in INFO_SET})
    new = _one_per_aoid(anti_join(conform(workers, "employee_info"), inf, "aoid")).select(*inf.columns)
    return upd.unionByName(new)


def soft_delete_employees(employees: DataFrame, workers: DataFrame, as_of: dt.datetime) -> DataFrame:
    return soft_delete(conform(employees, "employees"), workers, "aoid", as_of)


def cascade_employee_ids(children: dict, id_changes: DataFrame) -> dict:
    """Re-key history, hours, map and info rows after employee ids changed."""
    fks = {"employee_job_history": "employee_id", "employee_hours": "employee_id",
           "workforce_map": "employee_id", "employee_info": "id"}
    return {k: cascade_key(df, fks[k], id_changes) for k, df in children.items()}


def upsert_employees(employees: DataFrame, employee_info: DataFrame, workers: DataFrame,
                     titles: DataFrame, as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """The employee transaction: update, update info, insert, insert info, soft delete."""
    emp = update_employees(employees, workers, titles)
    emp = insert_employees(emp, workers, titles, as_of)
    emp = soft_delete_employees(emp, workers, as_of)
    return emp, upsert_employee_info(employee_info, workers)
