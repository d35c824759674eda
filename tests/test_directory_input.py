"""Directory exports that are damaged or cut short, in batch and streaming."""

import datetime as dt
import json
import os
import time

import pytest

from staffline import jobs
from staffline.operators import accounts as A
from staffline.sources import documents as DOC
from staffline.sources.sinks import read_latest, runs_of
from staffline.streaming import start_directory_ingest
from tests.test_streaming import _mark

AS_OF = dt.datetime(2024, 1, 1)


def _entry(no, title="T"):
    return json.dumps({"objectGUID": "{g%d}" % no, "sAMAccountName": f"a{no}", "title": title, "userAccountControl": 512})


def _export(path, *lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part.json"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_a_cut_off_line_deletes_nobody(spark, tmp_path):
    root = str(tmp_path / "tables")
    good = DOC.read_directory(spark, {"server1": _export(str(tmp_path / "1"), *map(_entry, (1, 2, 3)))})
    jobs.directory_run(spark, good, root, "1", AS_OF)
    cut = DOC.read_directory(spark, {"server1": _export(str(tmp_path / "2"), _entry(1), _entry(2)[:25], _entry(3))})
    with pytest.raises(Exception, match="does not parse"):
        jobs.directory_run(spark, cut, root, "2", AS_OF)
    empty = DOC.read_directory(spark, {"server1": _export(str(tmp_path / "3"), _entry(1), '{"sAMAccountName": "a2"}')})
    with pytest.raises(Exception, match="no objectGUID"):
        jobs.directory_run(spark, empty, root, "2", AS_OF)
    assert jobs.state(spark, root, "network_users").where("is_deleted").count() == 0
    jobs.directory_run(spark, cut, root, "2", AS_OF, mode="quarantine")
    bad = jobs.state(spark, root, "directory_quarantine").collect()
    assert [(r.source, r.error, r.entry) for r in bad] == [("server1", "entry does not parse", _entry(2)[:25])]


def test_a_short_export_does_not_delete_the_others(spark, tmp_path):
    root = str(tmp_path / "tables")
    read = lambda name, *no: DOC.read_directory(spark, {"server1": _export(str(tmp_path / name), *map(_entry, no))})
    jobs.directory_run(spark, read("1", *range(10)), root, "1", AS_OF)
    with pytest.raises(A.TooManyDeletions, match="8 of 10"):
        jobs.directory_run(spark, read("2", 0, 1), root, "2", AS_OF)
    assert jobs.state(spark, root, "network_users").where("is_deleted").count() == 0
    jobs.directory_run(spark, read("2", 0, 1), root, "2", AS_OF, max_deleted=0.8)
    assert jobs.state(spark, root, "network_users").where("is_deleted").count() == 8


def test_streaming_fails_on_both_and_goes_by_landing_time(spark, tmp_path):
    landing, table, ckpt = (str(tmp_path / d) for d in ("landing", "table", "ckpt"))

    def land(run_id, *lines):
        _export(f"{landing}/export={run_id}/source=server1", *lines)
        _mark(landing, run_id)

    def ingest(**kw):
        start_directory_ingest(spark, landing, table, ckpt, as_of_from_run=lambda r: AS_OF, **kw).awaitTermination()

    land("9", _entry(1, "nine"), _entry(2))
    time.sleep(0.05)
    land("10", _entry(1, "ten"), _entry(2))
    ingest()
    assert runs_of(spark, table) == ["9", "10"]
    assert {r.job_title for r in read_latest(spark, table).where("guid = 'g1'").collect()} == {"ten"}
    land("11", _entry(1), _entry(2)[:20])
    with pytest.raises(Exception, match="does not parse"):
        ingest()
    _export(f"{landing}/export=11/source=server1", _entry(3), _entry(4))
    with pytest.raises(Exception, match="would delete 2 of 2"):
        ingest()
    assert runs_of(spark, table) == ["9", "10"]
    ingest(max_deleted=None)
    assert runs_of(spark, table) == ["9", "10", "11"]
