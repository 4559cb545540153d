"""Run registered queries and compare them with their SQL in DuckDB.

python tools/check_oracles.py [--sf DIR] [--no-oracle] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketry.plans.catalog import CATALOG  # noqa: E402
from basketry.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return repr(value)
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat() if hasattr(value, "hour") else value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql):
    """Empty if equal, else a short description."""
    actual = df.collect()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows_of(df.columns, actual), rows_of(names, expected)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    if not a:
        return "both empty"
    off = [(x, y) for x, y in zip(a, b) if x != y]
    if off:
        return f"{len(off)} of {len(a)} rows differ, e.g. {off[0][0]} != {off[0][1]}"
    return ""


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session()
    con = connect(args.sf)
    bad = 0
    for name in args.names or CATALOG:
        query = CATALOG[name]
        start = time.time()
        try:
            df = query.run(spark, args.sf)
            if query.oracle:
                message = differences(df, con, query.oracle)
            else:
                message = "" if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001  (report and go on)
            message = f"{type(error).__name__}: {str(error)[:600]}"
        status = "ok " if not message else "BAD"
        bad += bool(message)
        print(f"{status} {time.time() - start:6.2f}s {name} {'' if query.oracle else '(rows only) '}{message}", flush=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
