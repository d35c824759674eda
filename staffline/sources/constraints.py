"""Keys, NOT NULL columns and references of the stored tables, checked before a run commits.

Parquet enforces none of them. A run checks the states that it wrote (of a table kept in parts, the
parts that it wrote) when all its tables are there, as deferred constraints, and a state that breaks one is never
named by a commit. Each table costs one aggregate on its key, and one anti join of the
distinct values for each reference; only counts reach the driver.

What was broken before a run is not its doing (a state taken over from elsewhere, or written before a column
was declared): a run fails where more rows break a constraint than in the state that it started from.

A repeated key counts its rows beyond the first; a NULL in a key counts as a missing value, not as a
repeat; a NULL reference refers to nothing and is allowed where the column is not required. Columns
that a frame lacks are not checked, and tables that are not declared have no constraints.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The constraints that the warehouse declares for its tables.
KEYS: dict[str, tuple[str, ...]] = {
    "workforce_map": ("id",), "network_users": ("id",), "employee_job_titles": ("id",), "locations": ("id",),
    "departments": ("id",), "employees": ("id",), "employee_job_history": ("id",),
    "employee_hours": ("employee_id", "date"), "contractors": ("id",), "contractor_job_hours": ("id",),
    "learners": ("id",), "learner_job_hours": ("id",), "volunteers": ("id",), "volunteer_job_hours": ("id",),
}
REQUIRED: dict[str, tuple[str, ...]] = {
    "employee_job_titles": ("job_title_id", "job_title"),
    "locations": ("location",),
    "departments": ("name",),
    "employees": ("aoid", "location_id", "department_id", "job_title_id", "legal_first_name", "legal_last_name"),
    "employee_info": ("id", "aoid"),
    "employee_job_history": ("employee_id", "job_title_id", "start_date"),
    "employee_hours": ("job_title_id", "work_minutes", "paid_minutes", "regular_minutes"),
    "timecard_dates": ("period_start", "date"),
    "contractors": ("name",), "contractor_job_hours": ("contractor_id", "start_date"),
    "learners": ("external_id", "name"), "learner_job_hours": ("learner_id", "start_date"),
    "volunteer_job_hours": ("volunteer_id", "start_date"),
}
#: Column -> table whose ``id`` it names.
REFERENCES: dict[str, dict[str, str]] = {
    "employees": {"location_id": "locations", "department_id": "departments", "job_title_id": "employee_job_titles"},
    "employee_info": {"id": "employees"},
    "employee_job_history": {"employee_id": "employees", "job_title_id": "employee_job_titles"},
    "employee_hours": {"employee_id": "employees", "job_title_id": "employee_job_titles"},
    "contractors": {"location_id": "locations"}, "contractor_job_hours": {"contractor_id": "contractors"},
    "learners": {"location_id": "locations"}, "learner_job_hours": {"learner_id": "learners"},
    "volunteers": {"location_id": "locations", "department_id": "departments"},
    "volunteer_job_hours": {"volunteer_id": "volunteers"},
}


class BrokenConstraint(ValueError):
    """A state breaks a declared key, NOT NULL column or reference."""


def broken_rows(rows: DataFrame, table: str, lacking: bool = False) -> dict[str, int]:
    """How many rows break the key and the required columns of a state, by one aggregate. With ``lacking``
    a required column that the frame lacks is missing in all its rows."""
    key = [c for c in KEYS.get(table, ()) if c in rows.columns]
    key = key if len(key) == len(KEYS.get(table, ())) else []
    declared = dict.fromkeys((*KEYS.get(table, ()), *REQUIRED.get(table, ())))
    needed = [c for c in declared if c in rows.columns or lacking]
    if not needed:
        return {}
    nulls = [F.count_if(F.col(c).isNull()) if c in rows.columns else F.count(F.lit(1)) for c in needed]
    if key:
        whole = reduce(and_, [F.col(c).isNotNull() for c in key])
        groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__rows"), *(n.alias(f"__null{i}") for i, n in enumerate(nulls)))
        found = groups.agg(F.sum(F.when(whole, F.col("__rows") - 1)), *(F.sum(f"__null{i}") for i in range(len(needed))))
    else:
        found = rows.agg(F.lit(0), *nulls)
    repeated, *missing = found.first()
    counts = {f"rows repeat the key ({', '.join(key)})": repeated} | {f"rows without {c}": n for c, n in zip(needed, missing)}
    return {why: n for why, n in counts.items() if n}


def dangling(rows: DataFrame, column: str, parent: DataFrame, name: str) -> dict[str, int]:
    """Rows whose reference names no row of ``parent``; equal values are counted before the join."""
    values = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("__v")).agg(F.count(F.lit(1)).alias("__rows"))
    lost = values.join(parent.select(F.col("id").alias("__id")), F.col("__v") == F.col("__id"), "left_anti")
    n = lost.agg(F.sum("__rows")).first()[0]
    return {f"rows whose {column} is not in {name}": n} if n else {}


def orphaned(rows: DataFrame, table: str, column: str, removed: DataFrame, name: str) -> list[str]:
    """Rows that name one of the ids that a run took out of ``name``."""
    n = rows.join(removed, F.col(column) == F.col("__id"), "left_semi").count()
    return [f"{table}: {n} rows whose {column} is no longer in {name}"] if n else []


def removed_ids(before: DataFrame, after: DataFrame) -> DataFrame:
    return before.select(F.col("id").alias("__id")).join(after.select(F.col("id").alias("__now")),
                                                         F.col("__id") == F.col("__now"), "left_anti")
