"""Run the named queries and compare them with their SQL in DuckDB.

    python compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import glob
import math
import os
import time

import duckdb

from meterlake.catalog.registry import ORACLES, QUERIES
from meterlake.plans.session import build_session


def canonical(value):
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else repr(value + 0.0)
    if value is None:
        return "NULL"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = build_session("8")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    bad = 0
    for name in args.names or list(QUERIES):
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            left = [tuple(r) for r in df.collect()]
        except Exception as error:  # report and go on
            bad += 1
            print(f"ERROR {name}: {str(error)[:600]}", flush=True)
            continue
        took = time.time() - start
        if name not in ORACLES:
            print(f"rows  {name}: {len(left)} rows, {took:.1f}s", flush=True)
            continue
        try:
            res = con.execute(ORACLES[name])
        except Exception as error:
            bad += 1
            print(f"SQLERR {name}: {str(error)[:600]}", flush=True)
            continue
        names = [d[0] for d in res.description]
        right = res.fetchall()
        if sorted(names) != sorted(df.columns):
            bad += 1
            print(f"DIFF  {name}: columns {sorted(df.columns)} / {sorted(names)}", flush=True)
            continue
        a, b = rows_of(df.columns, left), rows_of(names, right)
        if a == b:
            print(f"ok    {name}: {len(a)} rows, {took:.1f}s", flush=True)
        else:
            bad += 1
            only_a, only_b = set(a) - set(b), set(b) - set(a)
            print(f"DIFF  {name}: {len(a)} / {len(b)} rows, {len(only_a)} / {len(only_b)} differ", flush=True)
            print("   cols ", sorted(names))
            for side, rows in (("spark", sorted(only_a)[:2]), ("sql", sorted(only_b)[:2])):
                for row in rows:
                    print("   ", side, row)
    print(f"{bad} problem(s)")


if __name__ == "__main__":
    main()
