"""Sinks: table states per run, run-log appends, reporting views.

A stored table is a folder with one full state per run, ``run=<id>``. After a
state is written, an empty file ``_runs/<sequence>.<run id>`` marks it complete; the
sequence counts up, so that the order of runs is the order of writing, whatever
their ids. Readers list that folder (no data file is opened) and read one run's
folder only. A state without a mark is half written and never read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffline.operators import views as V
from staffline.params import Params

_RUN_ID = re.compile(r"[A-Za-z0-9._-]+")


class NoState(FileNotFoundError):
    """A table has no complete state (before the run asked about)."""


def files_of(spark: SparkSession, path: str):
    """File system and path object, for any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def runs_of(spark: SparkSession, table_path: str) -> list[str]:
    """Run ids of a table's complete states, in the order they were written."""
    fs, p = files_of(spark, f"{table_path}/_runs")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return [n.split(".", 1)[1] for n in sorted(n for n in names if re.match(r"\d+\.", n))]


def write_state(df: DataFrame, table_path: str, run_id: str) -> None:
    """Write the table's full state of a run (SNK-1) and mark it complete.

    A retried run replaces its own state and keeps its place among the runs."""
    if not _RUN_ID.fullmatch(run_id):
        raise ValueError(f"run id {run_id!r}: letters, digits, '.', '_' and '-' only")
    spark = df.sparkSession
    known = runs_of(spark, table_path)
    df.write.mode("overwrite").parquet(f"{table_path}/run={run_id}")
    if run_id not in known:
        fs, p = files_of(spark, f"{table_path}/_runs/{len(known):012d}.{run_id}")
        fs.create(p, False).close()


def read_run(spark: SparkSession, table_path: str, run_id: str) -> DataFrame:
    """The state written by one run."""
    if run_id not in runs_of(spark, table_path):
        raise NoState(f"no complete state {run_id} of {table_path}")
    return spark.read.parquet(f"{table_path}/run={run_id}")


def read_runs(spark: SparkSession, table_path: str) -> DataFrame:
    """All complete states of a table, with their ``run`` id as text."""
    runs = runs_of(spark, table_path)
    if not runs:
        raise NoState(f"no complete state of {table_path}")
    # One scan over the folders of all runs; the id is taken from the path, since a partition column would become a number.
    states = spark.read.option("mergeSchema", True).parquet(*(f"{table_path}/run={r}" for r in runs))
    return states.withColumn("run", F.regexp_extract("_metadata.file_path", "/run=([^/]+)/[^/]+$", 1))


def read_latest(spark: SparkSession, table_path: str, before: str | None = None) -> DataFrame:
    """The newest state of a table; with ``before`` the newest that was written
    before that run (what a retried run must start from; a new run comes last)."""
    runs = runs_of(spark, table_path)
    if before in runs:
        runs = runs[:runs.index(before)]
    if not runs:
        raise NoState(f"no complete state of {table_path}" + (f" before {before}" if before else ""))
    return read_run(spark, table_path, runs[-1])


def register_reporting_views(tables: dict, params: Params, prefix: str = "") -> list[str]:
    """``CREATE VIEW`` x7 as temp views over lazy plans (SNK-4)."""
    views = {
        "view_workforce": V.view_people(tables, params),
        "view_workforce_hours": V.view_hours(tables, params),
        "view_employees": V.view_employees(tables, params),
        "view_employee_job_history": V.view_job_history(tables),
        "view_contractors": V.view_contractors(tables, params),
        "view_learners": V.view_learners(tables, params),
        "view_volunteers": V.view_volunteers(tables, params),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]
