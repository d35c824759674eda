"""One commit for all tables of a run.

A run writes each table to a folder of its own attempt,
``<root>/<table>/run=<run id>.<job>.<attempt>``, and last of all one small file
``<root>/_commits/<sequence>.<run id>.<job>.json`` that names the folder of every table. Readers
take all tables from the newest such file, so they see a run's tables together or
not at all, and a run that breaks off changes nothing that they see.

A retried run reads what its first attempt read: the tables of the commit before that
attempt. It replaces the tables that it writes, unless another run has written one of them since
(``Conflict``: later states were built on it; the same holds for two runs at once).

A table may be kept in parts, one folder for each value of a column (months); a run then names
new folders for the parts that it wrote and the old ones for the others.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from staffline.schemas import TABLES
from staffline.session import staged
from staffline.sources import constraints as C
from staffline.sources.sinks import NoState, files_of, read_latest

_NAME = re.compile(r"(\d{12})\.(.+)\.json")
_ID = re.compile(r"[A-Za-z0-9._-]+")


class Conflict(RuntimeError):
    """Another run has written a table of this run since the state that it started from."""


def commits_of(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(sequence, run id and job) of every commit, oldest first; one listing, no file is read."""
    fs, p = files_of(spark, f"{root}/_commits")
    if not fs.exists(p):
        return []
    found = (_NAME.fullmatch(s.getPath().getName()) for s in fs.listStatus(p))
    return sorted((int(m[1]), m[2]) for m in found if m)


def _load(spark: SparkSession, root: str, seq: int, key: str) -> dict:
    return json.loads(spark.read.text(f"{root}/_commits/{seq:012d}.{key}.json", wholetext=True).first()[0])


NOTHING = {"seq": -1, "tables": {}}


def newest(spark: SparkSession, root: str) -> dict:
    """The newest commit: its sequence, and the folders of every table."""
    known = commits_of(spark, root)
    return _load(spark, root, *known[-1]) if known else NOTHING


def _read(spark: SparkSession, root: str, table: str, entry: dict, parts: set | None = None) -> DataFrame:
    if "parts" not in entry:
        return spark.read.parquet(f"{root}/{entry['path']}")
    paths = [f"{root}/{p}" for part, p in sorted(entry["parts"].items()) if parts is None or part in parts]
    return spark.read.parquet(*paths) if paths else spark.createDataFrame([], TABLES[table])


def state(spark: SparkSession, root: str, table: str, initial: DataFrame | None = None,
          commit: dict | None = None) -> DataFrame:
    """``table`` as of the newest commit (or of ``commit``). Where no commit names it, its newest single
    state (``sinks.write_state``); before any, ``initial`` or an empty table."""
    entry = (commit or newest(spark, root))["tables"].get(table)
    if entry:
        return _read(spark, root, table, entry)
    try:
        return read_latest(spark, f"{root}/{table}")
    except NoState:  # nothing written yet; any other failure to read ends the run
        return initial if initial is not None else spark.createDataFrame([], TABLES[table])


class Run:
    """The tables of one attempt of a run; leave the ``with`` block after ``commit``.

    Leaving it takes away the staging folder of the attempt, and without a commit the
    folders of its tables too. ``constraints``: check the declared keys, NOT NULL columns and
    references (``sources.constraints``) before the commit; the four scheduled runs do."""

    def __init__(self, spark: SparkSession, root: str, run_id: str, job: str, constraints: bool = False):
        if not _ID.fullmatch(run_id):
            raise ValueError(f"run id {run_id!r}: letters, digits, '.', '_' and '-' only")
        self.spark, self.root, self.key = spark, root, f"{run_id}.{job}"
        known = commits_of(spark, root)
        self.own = [seq for seq, key in known if key == self.key]
        last = _load(spark, root, *known[-1]) if known else NOTHING
        self.base = last
        if self.own:
            before = _load(spark, root, self.own[0], self.key)["base"]
            self.base = next((_load(spark, root, seq, key) for seq, key in known if seq == before), NOTHING)
        self.attempt = f"{self.key}.{uuid.uuid4().hex[:8]}"
        self.tables: dict[str, dict] = {}
        self.given: dict[str, DataFrame] = {}
        self.constraints = constraints
        self.done = False
        self._check(last)

    def __enter__(self) -> Run:
        self._stage = staged(f"{self.root}/_staging/{self.attempt}")
        self._stage.__enter__()
        return self

    def __exit__(self, *why) -> None:
        self._stage.__exit__(*why)
        self._delete(f"_staging/{self.attempt}")
        if not self.done:
            for table in self.tables:
                self._delete(f"{table}/run={self.attempt}")

    def _delete(self, path: str) -> None:
        fs, p = files_of(self.spark, f"{self.root}/{path}")
        fs.delete(p, True)

    def read(self, table: str, initial: DataFrame | None = None) -> DataFrame:
        """What this attempt wrote, else the state that the run starts from."""
        if initial is not None:
            self.given[table] = initial
        if table in self.tables:
            return _read(self.spark, self.root, table, self.tables[table])
        return state(self.spark, self.root, table, initial, self.base)

    def entry(self, table: str) -> dict:
        """The commit's entry of a table that the run starts from."""
        return self.base["tables"].get(table, {})

    def written(self, table: str) -> DataFrame:
        """Only what this attempt wrote of a table kept in parts."""
        entry = self.tables[table]
        mine = {k for k, p in entry["parts"].items() if f"/run={self.attempt}/" in p}
        return _read(self.spark, self.root, table, entry, mine)

    def read_parts(self, table: str, parts: set) -> DataFrame:
        """Only the named parts of a table kept in parts."""
        return _read(self.spark, self.root, table, self.entry(table), parts)

    def write(self, df: DataFrame, table: str, **facts) -> DataFrame:
        path = f"{table}/run={self.attempt}"
        df.write.mode("overwrite").parquet(f"{self.root}/{path}")
        self.tables[table] = {"path": path, **facts}
        return self.read(table)

    def write_parts(self, df: DataFrame, table: str, by: str, touched: set | None, **facts) -> DataFrame:
        """Write the rows of the ``touched`` parts (all parts: None) of a table kept in parts of column
        ``by``, which is not stored in them; the other parts keep their folders."""
        path = f"{table}/run={self.attempt}"
        df.repartition(by).write.mode("overwrite").partitionBy(by).parquet(f"{self.root}/{path}")
        fs, p = files_of(self.spark, f"{self.root}/{path}")
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        kept = {} if touched is None else {k: v for k, v in self.entry(table).get("parts", {}).items() if k not in touched}
        self.tables[table] = {"parts": kept | {n.split("=", 1)[1]: f"{path}/{n}" for n in names}, **facts}
        return self.read(table)

    def _check(self, last: dict) -> None:
        """No table that this run writes (or wrote before) may have come from another run since."""
        mine = set(self.tables) | {t for t, e in last["tables"].items() if e["by"] in self.own}
        if self.own:  # tables of the first attempt that a later run replaced
            mine |= {t for t, e in _load(self.spark, self.root, self.own[-1], self.key)["tables"].items() if e["by"] in self.own}
        for table in sorted(mine):
            by = last["tables"].get(table, {}).get("by")
            if by not in (self.entry(table).get("by"), *self.own):
                raise Conflict(f"{table}: another run has written it since the state before {self.key}")

    def _before(self, table: str) -> DataFrame | None:
        """The state that the run starts from; None where there is none."""
        if table in self.base["tables"]:
            return _read(self.spark, self.root, table, self.entry(table))
        try:
            return read_latest(self.spark, f"{self.root}/{table}")
        except NoState:
            return self.given.get(table)

    def _now(self, table: str) -> DataFrame | None:
        return self.read(table) if table in self.tables else self._before(table)

    def _counts(self, table: str, rows: DataFrame, of, lacking: bool = False) -> dict[str, int]:
        """How many of the rows break which constraint; ``of`` gives the table that a reference names."""
        found = C.broken_rows(rows, table, lacking)
        for column, name in C.REFERENCES.get(table, {}).items():
            parent = of(name)
            if parent is not None and column in rows.columns and "id" in parent.columns:
                found |= C.dangling(rows, column, parent, name)
        return found

    def broken(self) -> list[str]:
        """The constraints that more rows break than before the run: keys, required columns and references of what it
        wrote, and references of other rows to ids that it took out. A reference to a table
        that has no state at all is not checked."""
        out = []
        for table, entry in self.tables.items():
            found = self._counts(table, self.written(table) if "parts" in entry else self.read(table), self._now)
            before = self._before(table) if found else None
            if before is not None and "parts" in entry and "parts" in self.entry(table):  # the same parts
                mine = {k for k, p in entry["parts"].items() if f"/run={self.attempt}/" in p}
                before = self.read_parts(table, mine)
            known = self._counts(table, before, self._before, lacking=True) if before is not None else {}
            out += [f"{table}: {n} {why}" + (f" ({known[why]} before)" if why in known else "")
                    for why, n in found.items() if n > known.get(why, 0)]
        for name in self.tables:
            children = [(t, c) for t, refs in C.REFERENCES.items() for c, p in refs.items()
                        if p == name and (t not in self.tables or "parts" in self.tables[t])]
            before = self._before(name) if children else None
            if before is None or "id" not in before.columns:
                continue
            removed = C.removed_ids(before, self.read(name))
            if removed.isEmpty():  # the usual case: rows are flagged deleted, not taken out
                continue
            for table, column in children:
                rows = self._now(table)
                if rows is not None and column in rows.columns:
                    out += C.orphaned(rows, table, column, removed, name)
        return out

    def commit(self) -> None:
        """Name the tables of the run, together with those of all other runs."""
        if self.constraints and (broken := self.broken()):
            raise C.BrokenConstraint("; ".join(broken))
        last = newest(self.spark, self.root)
        self._check(last)
        seq = last["seq"] + 1
        tables = last["tables"] | {t: {**e, "by": seq} for t, e in self.tables.items()}
        text = json.dumps({"seq": seq, "base": self.base["seq"], "tables": tables})
        fs, made = files_of(self.spark, f"{self.root}/_commits/.{self.attempt}")
        out = fs.create(made, True)
        out.write(bytearray(text.encode()))
        out.close()
        if any(s == seq for s, _ in commits_of(self.spark, self.root)):
            raise Conflict(f"another run has committed while {self.key} did")
        _, final = files_of(self.spark, f"{self.root}/_commits/{seq:012d}.{self.key}.json")
        if not fs.rename(made, final):
            raise Conflict(f"another run has committed while {self.key} did")
        self.done = True
