"""Landing-folder ingestion: two exports, two runs, same result as batch."""

import datetime as dt
import glob
import json
import os
import tempfile
import time

import pytest

from pyspark.sql import functions as F

from staffline.operators.accounts import reconcile_accounts
from staffline.operators.dedupe import resolve_all
from staffline.operators.flatten import flatten_directory
from staffline.session import cut_lineage
from staffline.sources.documents import directory_entries_from_tables
from staffline.sources.sinks import read_run, read_runs, runs_of
from staffline.streaming import start_directory_ingest
from staffline.streaming.landing import read_export

SF = "/root/testdata/sf0.001"


def _land(entries, root, export, complete=True, mode="overwrite"):
    for src in ("server1", "server2"):
        (entries.filter(F.col("source") == src).drop("source")
         .write.mode(mode).json(os.path.join(root, f"export={export}", f"source={src}")))
    if complete:
        _mark(root, export)


def _mark(root, export):
    files = len(glob.glob(os.path.join(root, f"export={export}", "*", "*.json")))
    os.makedirs(os.path.join(root, "complete"), exist_ok=True)
    with open(os.path.join(root, "complete", f"{export}-{time.time_ns()}.json"), "w") as f:
        f.write(json.dumps({"export": export, "files": files}))


def test_two_exports_match_batch(spark):
    work = tempfile.mkdtemp(prefix="staffline-stream-")
    landing, table, ckpt = (os.path.join(work, d) for d in ("landing", "table", "ckpt"))
    customer = spark.read.parquet(f"{SF}/customer.parquet")
    first = directory_entries_from_tables(customer)
    second = directory_entries_from_tables(customer.filter(F.col("c_custkey") % 7 != 0)) \
        .withColumn("title", F.when(F.col("objectGUID").endswith("5}"), F.lit("Changed")).otherwise(F.col("title")))
    _land(first, landing, "2024-01-01")
    _land(second, landing, "2024-02-01")
    as_of = lambda run: dt.datetime.fromisoformat(run)
    log = os.path.join(work, "log")
    start_directory_ingest(spark, landing, table, ckpt, as_of_from_run=as_of, log_path=log).awaitTermination()
    got = read_runs(spark, table).filter("run = '2024-02-01'").drop("run")
    logs = {r.run: r for r in read_runs(spark, log).collect()}
    assert logs["2024-01-01"].insert_count == customer.count()  # first run inserts everyone
    assert logs["2024-02-01"].delete_count == customer.filter(F.col("c_custkey") % 7 == 0).count()

    # The same two runs in batch form.
    state = spark.createDataFrame([], got.schema)
    for export, entries in (("2024-01-01", first), ("2024-02-01", second)):
        state = cut_lineage(resolve_all(reconcile_accounts(state, flatten_directory(entries), as_of(export))))
    cols = sorted(got.columns)
    a = sorted(map(tuple, got.select(cols).collect()), key=repr)
    b = sorted(map(tuple, state.select(cols).collect()), key=repr)
    assert a == b
    assert got.filter("is_deleted").count() == customer.filter(F.col("c_custkey") % 7 == 0).count()

    # A second call finds nothing new and writes nothing.
    start_directory_ingest(spark, landing, table, ckpt, as_of_from_run=as_of).awaitTermination()
    assert read_runs(spark, table).select("run").distinct().count() == 2


def test_half_landed_and_late_files(spark):
    work = tempfile.mkdtemp(prefix="staffline-late-")
    landing, table, ckpt = (os.path.join(work, d) for d in ("landing", "table", "ckpt"))
    customer = spark.read.parquet(f"{SF}/customer.parquet")
    entries = directory_entries_from_tables(customer)
    few = entries.limit(1)
    as_of = lambda run: dt.datetime(2024, 1, 1)

    def ingest():
        start_directory_ingest(spark, landing, table, ckpt, as_of_from_run=as_of).awaitTermination()
        return {r: read_run(spark, table, r).count() for r in runs_of(spark, table)}

    os.makedirs(os.path.join(landing, "complete"))
    _land(entries, landing, "1", complete=False)
    assert ingest() == {}                                    # half landed: nothing happens
    _mark(landing, "1")
    assert ingest() == {"1": customer.count()}
    _land(few, landing, "1", complete=False, mode="append")  # a late file without a marker changes nothing
    assert ingest() == {"1": customer.count()}
    _mark(landing, "1")                                      # with one, the whole export is read again
    assert ingest() == {"1": customer.count()}
    assert read_run(spark, table, "1").filter("is_deleted").count() == 0
    _land(entries, landing, "2")
    assert list(ingest()) == ["1", "2"]
    _mark(landing, "1")
    with pytest.raises(Exception, match="older than the stored state"):
        ingest()


def test_marker_with_wrong_count_fails(spark):
    work = tempfile.mkdtemp(prefix="staffline-count-")
    landing = os.path.join(work, "landing")
    _land(directory_entries_from_tables(spark.read.parquet(f"{SF}/customer.parquet")), landing, "a")
    with pytest.raises(ValueError, match="its marker says"):
        read_export(spark, landing, "a", 10_000)
