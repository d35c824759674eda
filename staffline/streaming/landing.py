"""Incremental runs over a landing folder with Structured Streaming.

The extraction step lands one full directory export per run under
``<landing>/export=<run id>/source=<server>/*.json`` and, when all of its files are
there, one line ``{"export": <run id>, "files": <count>}`` as a file under
``<landing>/complete/``. The file stream reads only these markers, so a
half-landed export is never taken for a full snapshot. ``foreachBatch`` reads the
whole export that a marker names, checks the number of its files, reconciles it
against the latest stored state and writes the next state as
``<table>/run=<run id>``.

A batch replayed after a failure, and a marker written again for the newest run,
start from the state before that run and replace its own state. A marker for an
older run is an error: later states were built on it. Files that come after their
export's marker change nothing until a new marker names them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from staffline.operators.accounts import MAX_DELETED, check_deletions, reconcile_accounts
from staffline.operators.dedupe import resolve_all
from staffline.operators.flatten import flatten_directory
from staffline.schemas import TABLES
from staffline.session import cut_lineage
from staffline.sources.documents import CORRUPT, DIRECTORY_SCHEMA
from staffline.sources.sinks import NoState, read_latest, runs_of, write_state

MARKER_SCHEMA = "export string, files long"


def _latest_state(spark: SparkSession, table_path: str, initial: DataFrame | None, before: str) -> DataFrame:
    """Newest state before run ``before`` (a replayed batch starts from the same state)."""
    try:
        return read_latest(spark, table_path, before)
    except NoState:  # no earlier run; any other failure to read ends the run
        if initial is None:
            return spark.createDataFrame([], TABLES["network_users"])
        return initial


def reconcile_export(spark: SparkSession, export: DataFrame, table_path: str, run_id: str,
                     as_of: dt.datetime, initial: DataFrame | None = None,
                     log_path: str | None = None, max_deleted: float | None = MAX_DELETED) -> dict:
    """One run: flatten the export, reconcile, resolve duplicates, write ``run=<id>``. An entry that
    cannot be read, or more deletions than the share ``max_deleted``, ends it before it writes.

    Run metrics are observed while the state is written (no extra job):
    rows, inserted, soft-deleted and newly disabled accounts of this run. With
    ``log_path`` they are appended as a run-log row.
    """
    users = _latest_state(spark, table_path, initial, run_id)
    snapshot = cut_lineage(flatten_directory(export))
    check_deletions(users, snapshot, max_deleted)
    out = resolve_all(reconcile_accounts(users, snapshot, as_of), checkpoint_between=True)
    ts = F.lit(as_of).cast("timestamp")
    obs = Observation(f"directory-run-{run_id}")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"),
                      F.count_if(F.col("inserted_at") == ts).alias("inserted"),
                      F.count_if(F.col("deleted_at") == ts).alias("deleted"),
                      F.count_if(F.col("disabled_at") == ts).alias("disabled"))
    write_state(out, table_path, run_id)  # idempotent: a replayed batch overwrites its own run
    metrics = dict(obs.get)
    if log_path:
        row = spark.createDataFrame(
            [(run_id, as_of, int(metrics["rows"]), int(metrics["inserted"]), int(metrics["deleted"]),
              int(metrics["disabled"]))],
            "run string, logged_at timestamp, query_count long, insert_count long, delete_count long, "
            "disabled_count long")
        write_state(row.drop("run"), log_path, run_id)
    return metrics


def read_export(spark: SparkSession, landing_dir: str, run_id: str, files: int) -> DataFrame:
    """All entries of one landed export, tagged with their ``source``; an error
    if it has not as many files as its marker says."""
    export = (spark.read.schema(f"{DIRECTORY_SCHEMA}, source string, {CORRUPT} string")
              .option("columnNameOfCorruptRecord", CORRUPT).option("basePath", f"{landing_dir}/export={run_id}")
              .json(f"{landing_dir}/export={run_id}"))
    found = len(export.inputFiles())
    if found != files:
        raise ValueError(f"export {run_id} has {found} files, its marker says {files}")
    return export


def start_directory_ingest(spark: SparkSession, landing_dir: str, table_path: str, checkpoint_location: str,
                           initial: DataFrame | None = None, as_of_from_run=None,
                           log_path: str | None = None, max_deleted: float | None = MAX_DELETED) -> StreamingQuery:
    """Process every export completed since the last call, in the order in which
    their markers were written, then stop. The default time of a run is the current time in UTC."""
    as_of_from_run = as_of_from_run or (lambda run_id: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        # One small marker per completed export; the latest one counts.
        latest = batch.groupBy("export").agg(F.max_by("files", "written").alias("files"), F.max("written").alias("written"))
        markers = {r.export: r.files for r in latest.orderBy("written", "export").collect()}
        for run_id in markers:
            stored = runs_of(spark, table_path)
            if run_id in stored[:-1] and not set(stored[stored.index(run_id) + 1:]) <= set(markers):
                raise ValueError(f"export {run_id} is older than the stored state")
            export = read_export(spark, landing_dir, run_id, markers[run_id])
            reconcile_export(spark, export, table_path, run_id, as_of_from_run(run_id), initial, log_path, max_deleted)

    stream = (spark.readStream.schema(MARKER_SCHEMA).json(f"{landing_dir}/complete")
              .select("export", "files", F.col("_metadata.file_modification_time").alias("written")))
    return (stream.writeStream.foreachBatch(each_batch)
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())
