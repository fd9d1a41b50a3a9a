"""Run a registered query and its oracle SQL side by side.

python -m tests.oracle [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import decimal
import glob
import math
import os
import time

import duckdb

TESTDATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def normal_rows(columns, rows):
    """Rows as tuples of (type, value) in column-name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: tuple((v is not None, type(v).__name__, v) for v in r))


def compare(spark, name: str, sf_dir: str, con=None) -> str:
    """Empty when equal, else a short account of the first difference."""
    from tracklab.plans.catalogue import ORACLES, QUERIES

    df = QUERIES[name](spark, sf_dir)
    got_columns, got = normal_rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return "" if got else "no rows"
    cursor = (con or connect(sf_dir)).execute(ORACLES[name])
    want_columns, want = normal_rows([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows, oracle has {len(want)}; first {got[:2]} / {want[:2]}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"{got_columns}: {g} != {w}"
    return ""


def main() -> None:
    from tracklab.plans.catalogue import QUERIES
    from tracklab.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"{TESTDATA}/sf{args.sf}"
    con = connect(sf_dir)
    bad = 0
    for name in args.names or QUERIES:  # one line per query as it finishes
        start = time.perf_counter()
        try:
            problem = compare(spark, name, sf_dir, con)
        except Exception as exc:  # report every query, not only the first failure
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.perf_counter() - start:.1f}s {problem}", flush=True)
    print(f"{bad} failures", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
