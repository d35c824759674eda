"""Differential check: each ``queries()`` key in Spark vs its ``oracle_sql()`` in DuckDB.

Usage: python tests/oracle_compare.py [--sf DIR] [key ...]
Compares column names, row count and the sorted multiset of rows (exact values).
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from staffline.sources.tables import BASE_TABLES  # noqa: E402

DEFAULT_SF = "/root/testdata/sf0.01"


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in BASE_TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return ("f", v)
    if isinstance(v, decimal.Decimal):
        return ("d", v)
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


_SPARK2DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
               "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
               "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT"}


def compare(spark, key: str, sf_dir: str, con=None, queries=None, oracles=None) -> dict:
    import __spark_entry__ as E
    queries = queries or E.queries()
    oracles = oracles or E.oracle_sql()
    con = con or duck(sf_dir)
    res = {"key": key}
    t0 = time.time()
    df = queries[key](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    res["spark_sec"] = round(time.time() - t0, 2)
    scols = df.columns
    res["spark_rows"] = len(srows)
    if key not in oracles:
        res["status"] = "rows-only"
        return res
    rel = con.sql(oracles[key])
    ocols = rel.columns
    otypes = [str(t) for t in rel.types]
    orows = rel.fetchall()
    res["oracle_rows"] = len(orows)
    stypes = [_SPARK2DUCK.get(t, t.upper()) for _, t in df.dtypes]
    tmis = [(c, s, o) for c, s, o in zip(scols, stypes, otypes) if s != o]
    if sorted(scols) != sorted(ocols):
        res["status"] = "COLUMNS"
        res["detail"] = f"spark-only={sorted(set(scols) - set(ocols))} oracle-only={sorted(set(ocols) - set(scols))}"
        return res
    if len(srows) != len(orows):
        res["status"] = "ROWCOUNT"
        return res
    a, b = _rows(scols, srows), _rows(ocols, orows)
    if a != b:
        res["status"] = "VALUES"
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        names = sorted(scols)
        res["detail"] = [[(n, xv, yv) for n, xv, yv in zip(names, x, y) if xv != yv] for x, y in diff]
        return res
    res["status"] = "OK" if not tmis else "OK-types"
    if tmis:
        res["types"] = tmis
    return res


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default=DEFAULT_SF)
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args(argv)
    from staffline.session import build_session
    import __spark_entry__ as E
    spark = build_session("local[8]", 8)
    qs, os_ = E.queries(), E.oracle_sql()
    keys = a.keys or sorted(qs)
    con = duck(a.sf)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, a.sf, con, qs, os_)
        except Exception as ex:  # report and continue
            r = {"key": k, "status": "ERROR", "detail": str(ex).splitlines()[0][:300]}
        if r["status"] not in ("OK", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
