"""Table states per run and reporting views."""

import glob
import os
import tempfile

import pytest

from staffline import jobs
from staffline.params import Params
from staffline.plans.registry import StaffTables
from staffline.sources.sinks import NoState, read_latest, read_run, register_reporting_views, runs_of, write_state

SF = "/root/testdata/sf0.001"


def test_state_per_run_and_views(spark):
    t = StaffTables(spark, SF)
    path = os.path.join(tempfile.mkdtemp(prefix="staffline-sink-"), "departments")
    write_state(t["departments"], path, "2024-01-01")
    write_state(t["departments"].limit(3), path, "2024-02-01")
    assert read_latest(spark, path).count() == 3
    names = register_reporting_views(t, Params(reporting_year=2000), prefix="t_")
    assert len(names) == 7
    assert spark.sql("SELECT COUNT(*) FROM t_view_workforce").first()[0] == t["workforce_map"].count()


def test_runs_are_ordered_by_writing(spark, tmp_path):
    path = str(tmp_path / "t")
    for run, n in (("9", 1), ("10", 2), ("b", 3)):
        write_state(spark.range(n), path, run)
    assert runs_of(spark, path) == ["9", "10", "b"]
    assert read_latest(spark, path).count() == 3 and read_latest(spark, path, before="b").count() == 2
    assert read_latest(spark, path, before="10").count() == 1
    assert read_latest(spark, path, before="new").count() == 3
    with pytest.raises(NoState):
        read_latest(spark, path, before="9")
    write_state(spark.range(7), path, "10")  # a retried run keeps its place
    assert read_latest(spark, path).count() == 3 and read_run(spark, path, "10").count() == 7


def test_only_a_missing_state_counts_as_empty(spark, tmp_path):
    root = str(tmp_path)
    assert jobs.state(spark, root, "departments").count() == 0
    write_state(spark.range(3), f"{root}/departments", "1")
    for part in glob.glob(f"{root}/departments/run=1/*.parquet"):
        with open(part, "wb") as f:
            f.write(b"damaged")
    with pytest.raises(Exception):
        jobs.state(spark, root, "departments").count()


def test_half_written_state_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(f"{path}/run=1")  # no mark: the run broke off
    with pytest.raises(NoState):
        read_latest(spark, path)
    with pytest.raises(ValueError):
        write_state(spark.range(1), path, "../x")
