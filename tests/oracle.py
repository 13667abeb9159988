"""Run a registered query and its SQL side by side and compare all values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return ("float", "nan")
        return ("float", f"{value + 0.0:.9g}")
    if isinstance(value, (list, tuple)):
        return ("list", tuple(plain(v) for v in value))
    if isinstance(value, (dt.datetime, dt.date)):
        return ("time", value.isoformat())
    return (type(value).__name__, str(value))


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, otherwise a description of the difference."""
    frame = query(spark, sf_dir)
    got = table(frame.columns, [tuple(r) for r in frame.collect()])
    if sql is None:
        return None if got[1] else "no rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = table(names, cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        here, there = set(got[1]), set(want[1])
        extra = sorted(here - there)[:3]
        lack = sorted(there - here)[:3]
        return f"rows {len(got[1])} vs {len(want[1])}\n   spark: {extra}\n   sql:   {lack}"
    return None if want[1] else "equal but empty"


def main(argv):
    from opsloom.catalog import ORACLES, QUERIES
    from opsloom.session import local_session

    sf_dir = argv[0]
    chosen = argv[1:] or list(QUERIES)
    spark, con = local_session(8), duck(sf_dir)
    bad = 0
    for name in [q for q in QUERIES if any(q == c or c.endswith("*") and q.startswith(c[:-1]) for c in chosen)]:
        start = time.time()
        try:
            problem = compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
            if "-v" in sys.argv:
                traceback.print_exc()
        bad += problem is not None
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    raise SystemExit(min(main(sys.argv[1:]), 1))
