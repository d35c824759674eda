"""Declared schemas of the stored tables (long-lived warehouse tables).

Parquet enforces none of the keys or defaults; the reconcile and audit
operators check or apply them. ``conform`` adds declared columns that an
input lacks as typed NULLs so every operator sees the full table shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DecimalType, LongType,
                               StringType, StructField, StructType, TimestampType)

# Ids and minutes are 64-bit throughout.
S, I, L, B, D, TS = StringType(), LongType(), LongType(), BooleanType(), DateType(), TimestampType()
DEC62 = DecimalType(6, 2)


def _schema(*cols) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


TABLES: dict[str, StructType] = {
    "workforce_map": _schema(("id", I), ("network_id", I), ("employee_id", I), ("contractor_id", I),
                             ("learner_id", I), ("volunteer_id", I), ("relevant_id", I),
                             ("epic_id", S), ("ecw_ids", S), ("analytics_id", I)),
    "network_users": _schema(("id", I), ("guid", S), ("primary_guid", S), ("source", S),
                             ("first_name", S), ("last_name", S), ("common_name", S),
                             ("display_name", S), ("network_email", S), ("primary_email", S),
                             ("email", S), ("job_title", S), ("account_name", S),
                             ("active_dir_group", S), ("department", S), ("location", S),
                             ("manager", S), ("user_description", S), ("phone_extension", S),
                             ("mobile_phone", S), ("created_at", TS), ("inserted_at", TS),
                             ("is_primary_acct", B), ("is_non_user", B), ("is_disabled", B),
                             ("disabled_at", TS), ("is_deleted", B), ("deleted_at", TS)),
    "employee_job_titles": _schema(("id", I), ("job_title_id", I), ("job_title", S), ("uds_line", S),
                                   ("hcai_line", S), ("has_clinical_admin_time", B), ("inserted_at", TS)),
    "locations": _schema(("id", I), ("location", S), ("epic_location_id", S), ("epic_location", S),
                         ("county", S)),
    "departments": _schema(("id", I), ("name", S)),
    "employees": _schema(("id", I), ("aoid", S), ("location_id", I), ("department_id", I),
                         ("reports_to_id", I), ("job_title_id", I), ("legal_first_name", S),
                         ("legal_middle_name", S), ("legal_last_name", S), ("preferred_first_name", S),
                         ("preferred_middle_name", S), ("preferred_last_name", S), ("gender", S),
                         ("pronouns", S), ("work_email", S), ("personal_email", S),
                         ("personal_mobile", S), ("status", S), ("employment_type", S),
                         ("hire_date", D), ("start_date", D), ("evaluation_date", D),
                         ("termination_date", D), ("hired_fte", DEC62), ("inserted_at", TS),
                         ("deleted_at", TS), ("is_deleted", B), ("is_manager", B)),
    "employee_info": _schema(("id", I), ("aoid", S), ("dob", D), ("address_line_1", S),
                             ("address_line_2", S), ("city", S), ("state", S), ("zip_code", S)),
    "employee_job_history": _schema(("id", I), ("employee_id", I), ("job_title_id", I),
                                    ("start_date", D), ("end_date", D), ("inserted_at", TS)),
    "employee_hours": _schema(("id", L), ("employee_id", I), ("job_title_id", I), ("date", D),
                              ("work_minutes", I), ("paid_minutes", I), ("regular_minutes", I)),
    "timecard_dates": _schema(("period_start", D), ("date", D)),
    "contractors": _schema(("id", I), ("name", S), ("first_name", S), ("last_name", S), ("email", S),
                           ("job_title", S), ("vendor", S), ("location_id", I), ("inserted_at", TS),
                           ("uds_line", S), ("hcai_line", S)),
    "contractor_job_hours": _schema(("id", I), ("contractor_id", I), ("invoice", S), ("job_title", S),
                                    ("start_date", D), ("end_date", D), ("uds_line", S),
                                    ("hcai_line", S), ("hours", DEC62), ("inserted_at", TS)),
    "learners": _schema(("id", I), ("external_id", S), ("name", S), ("first_name", S),
                        ("last_name", S), ("email", S), ("job_title", S), ("site", S),
                        ("location_id", I), ("supervisor", S), ("inserted_at", TS), ("uds_line", S),
                        ("hcai_line", S)),
    "learner_job_hours": _schema(("id", I), ("learner_id", I), ("job_title", S), ("start_date", D),
                                 ("end_date", D), ("uds_line", S), ("hcai_line", S),
                                 ("pre_graduate", S), ("post_graduate", S), ("workforce_role", S),
                                 ("hours", DEC62), ("inserted_at", TS)),
    "volunteers": _schema(("id", I), ("first_name", S), ("last_name", S), ("email", S),
                          ("job_title", S), ("location_id", I), ("department_id", I),
                          ("supervisor", S), ("inserted_at", TS), ("external_id", S),
                          ("is_event_only", B), ("uds_line", S), ("hcai_line", S)),
    "volunteer_job_hours": _schema(("id", I), ("volunteer_id", I), ("job_title", S),
                                   ("start_date", D), ("end_date", D), ("uds_line", S),
                                   ("hcai_line", S), ("hours", DEC62), ("inserted_at", TS),
                                   ("pre_graduate", S), ("post_graduate", S), ("workforce_role", S)),
    "holidays": _schema(("holiday", S), ("date", S)),
    "run_log": _schema(("id", I), ("query_type", S), ("logged_at", TS), ("query_count", L),
                           ("update_count", L), ("insert_count", L), ("failure_step", S),
                           ("warnings", S), ("is_success", B)),
}


# Column defaults declared by the DDL (applied when an input lacks the column).
DEFAULTS: dict[str, dict] = {
    "network_users": {"is_primary_acct": True, "is_non_user": False, "is_disabled": False, "is_deleted": False},
    "employees": {"is_deleted": False},
    "run_log": {"is_success": False},
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Add declared columns missing from ``df`` (their DDL default, else a
    typed NULL; existing columns keep their type); extra columns are kept at
    the end. Remembered on the input DataFrame itself (plans are immutable), which keeps
    driver-side plan construction cheap when a table feeds many operators and ends with the input."""
    memo = df.__dict__.setdefault("_conformed", {})
    if table not in memo:
        memo[table] = _conform(df, table)
    return memo[table]


def _conform(df: DataFrame, table: str) -> DataFrame:
    schema = TABLES[table]
    have = set(df.columns)
    defaults = DEFAULTS.get(table, {})
    cols = [F.col(f.name) if f.name in have else F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    extra = [F.col(c) for c in df.columns if c not in schema.fieldNames()]
    return df.select(*cols, *extra)


_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN", "date": "DATE",
         "timestamp": "TIMESTAMP", "decimal(6,2)": "DECIMAL(6,2)"}


def sql_default(table: str, col: str) -> str:
    """SQL literal of a missing column (DDL default or typed NULL), for oracles."""
    f = TABLES[table][col]
    d = DEFAULTS.get(table, {}).get(col)
    if d is None:
        return f"CAST(NULL AS {_DUCK[f.dataType.simpleString()]})"
    return "TRUE" if d is True else "FALSE" if d is False else repr(d)
