"""Run registered queries beside their oracle SQL and compare whole results.

    python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if value != value else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(str(_cell(v)) for v in value) + "]"
    return str(value)


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, build, oracle, sf_dir):
    """(matches, detail, seconds, rows)."""
    start = time.time()
    df = build(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if oracle is None:
        return True, "no oracle", took, len(rows)
    cursor = con.execute(oracle)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    a, b = normalized(df.columns, rows), normalized(names, theirs)
    if a[0] != b[0]:
        return False, f"columns {a[0]} vs {b[0]}", took, len(rows)
    if len(a[1]) != len(b[1]):
        return False, f"rows {len(a[1])} vs {len(b[1])}", took, len(rows)
    bad = [(x, y) for x, y in zip(a[1], b[1]) if x != y]
    if bad:
        return False, f"{len(bad)} of {len(rows)} rows differ on {a[0]}\n   spark {bad[0][0]}\n   duck  {bad[0][1]}", took, len(rows)
    return True, "", took, len(rows)


def main() -> int:
    from countloom.session import local_session

    import __spark_entry__ as entry

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con = local_session(cores="8"), duck(sf_dir)
    spark.sparkContext.setLogLevel("OFF")
    queries, oracles = entry.queries(), entry.oracle_sql()
    wanted = [n for n in queries if not args.names or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in args.names)]
    failed = 0
    for name in wanted:
        try:
            ok, detail, took, rows = compare(spark, con, queries[name], oracles.get(name), sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, detail, took, rows = False, f"{type(error).__name__}: {str(error)[:700]}", 0.0, 0
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:42s} {took:6.2f}s {rows:8d} {detail}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} fine")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
