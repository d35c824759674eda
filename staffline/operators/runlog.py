"""Run log (one row per run, appended to a Parquet table)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_log_row(counts: DataFrame, query_type: str, as_of: dt.datetime, query_count: str | None = None,
                update_count: str | None = None, insert_count: str | None = None,
                warnings: str | None = None, failure_step: str | None = None) -> DataFrame:
    """One log row built from a one-row counts frame (the counts are taken
    before the change is applied, in the same pass as the change)."""
    def pick(c):
        return F.col(c).cast("long") if c else F.lit(None).cast("long")
    return counts.select(
        F.lit(None).cast("long").alias("id"), F.lit(query_type).alias("query_type"),
        F.lit(as_of).cast("timestamp").alias("logged_at"),
        pick(query_count).alias("query_count"), pick(update_count).alias("update_count"),
        pick(insert_count).alias("insert_count"),
        F.lit(failure_step).cast("string").alias("failure_step"),
        (F.col(warnings) if warnings else F.lit(None)).cast("string").alias("warnings"),
        F.lit(failure_step is None).alias("is_success"))
