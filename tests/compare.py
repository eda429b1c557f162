"""Run registered queries against their SQL on one data folder."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return repr(round(float(value), 6) + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted([tuple(canonical(r[i]) for i in order) for r in rows], key=str)


def check(spark, con, key, fn, sql, sf_dir):
    """Return (row count, seconds, problem or None)."""
    start = time.time()
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - start
    if sql is None:
        return len(got[1]), seconds, None
    result = con.sql(sql)
    want = rows_of(result.columns, result.fetchall())
    if got[0] != want[0]:
        return len(got[1]), seconds, f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        missing = [r for r in want[1] if r not in set(got[1])][:3]
        extra = [r for r in got[1] if r not in set(want[1])][:3]
        return len(got[1]), seconds, f"{len(got[1])} rows vs {len(want[1])}\n  {got[0]}\n  want {missing}\n  got  {extra}"
    return len(got[1]), seconds, None


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import importlib

    from lineagespark.plans import registry
    from lineagespark.session import local_session

    sf_dir, modules, keys = argv[0], argv[1].split(","), set(argv[2:])
    if modules == ["all"]:
        registry.load_all()
    else:
        for m in modules:
            importlib.import_module(f"lineagespark.plans.{m}")
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for key, fn in registry.QUERIES.items():
        if keys and key not in keys:
            continue
        try:
            n, seconds, problem = check(spark, con, key, fn, registry.ORACLES.get(key), sf_dir)
        except Exception as error:  # noqa: BLE001
            n, seconds, problem = -1, 0.0, f"{type(error).__name__}: {str(error)[:700]}"
        mark = "ok " if problem is None else "BAD"
        note = "" if key in registry.ORACLES else " (no SQL)"
        print(f"{mark} {key:5} {n:7} rows {seconds:6.2f}s{note}{'' if problem is None else ' ' + problem}", flush=True)
        bad += problem is not None
    print(f"{bad} problems")


if __name__ == "__main__":
    main(sys.argv[1:])
