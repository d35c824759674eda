"""Registry of query keys: a Spark builder and (optionally) its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from staffline.plans.oracle import with_fixtures
from staffline.sources.tables import Catalog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Logical staffing table -> fixture recipe over the supplied test tables.
TABLE_FIXTURES = {
    "workforce_map": "fx_workforce_map",
    "network_users": "fx_network_users",
    "network_snapshot": "fx_network_snapshot",
    "employees": "fx_employees",
    "employee_hours": "fx_employee_hours",
    "employee_job_titles": "fx_job_titles",
    "employee_job_history": "fx_job_history",
    "locations": "fx_locations",
    "departments": "fx_departments",
    "workers_snapshot": "fx_workers_snapshot",
    "raw_timecards": "fx_raw_timecards",
    "contractors": "fx_contractors",
    "contractor_job_hours": "fx_contractor_job_hours",
    "learners": "fx_learners",
    "learner_job_hours": "fx_learner_job_hours",
    "volunteers": "fx_volunteers",
    "volunteer_job_hours": "fx_volunteer_job_hours",
    "ehr_users": "fx_ehr_users",
    "analytics_users": "fx_analytics_users",
    "clinical_users": "fx_clinical_users",
    "clinical_providers": "fx_clinical_providers",
    "worker_staging": "fx_worker_staging",
    "employee_info": "fx_employee_info",
    "timecard_dates": "fx_timecard_dates",
}


_CATALOGS: dict[tuple, Catalog] = {}


def catalog_for(spark: SparkSession, sf_dir: str) -> Catalog:
    """One catalog per (session, data folder): base tables and fixtures are
    analyzed once and their lazy DataFrames reused by every query."""
    key = (id(spark), spark.conf.get("spark.app.id", ""), sf_dir.rstrip("/"))
    if key not in _CATALOGS:
        _CATALOGS[key] = Catalog(spark, sf_dir)
    return _CATALOGS[key]


class StaffTables(Mapping):
    """Lazy mapping: logical table name -> DataFrame of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.cat = catalog_for(spark, sf_dir)

    def __getitem__(self, name: str) -> DataFrame:
        if name in TABLE_FIXTURES:
            return self.cat.fixture(TABLE_FIXTURES[name])
        return self.cat[name]

    def __iter__(self):
        return iter(TABLE_FIXTURES)

    def __len__(self) -> int:
        return len(TABLE_FIXTURES)


def query(key: str, oracle: str | None = None):
    """Register ``fn(t: StaffTables) -> DataFrame`` under ``key``."""

    def deco(fn: Callable[[StaffTables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Reports are computed in UTC whatever the caller's session zone is
            # (timestamps of the snapshots are wall-clock values).
            if spark.conf.get("spark.sql.session.timeZone") != "UTC":
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(StaffTables(spark, sf_dir))

        run.__name__ = f"q_{key}"
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = with_fixtures(oracle)
        return fn

    return deco
