"""Run every registered query and its SQL twin on the same tables and compare schema, rows and values.

Usage: python tools/check_sql.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import suite  # noqa: E402
from pressroom.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    return value


def compare(columns, rows, other_columns, other_rows):
    if sorted(columns) != sorted(other_columns):
        return f"columns differ: {sorted(columns)} / {sorted(other_columns)}"
    order, other = sorted(columns), sorted(other_columns)
    a = sorted((tuple(canonical(r[columns.index(c)]) for c in order) for r in rows), key=repr)
    b = sorted((tuple(canonical(r[other_columns.index(c)]) for c in other) for r in other_rows), key=repr)
    if len(a) != len(b):
        return f"row counts differ: {len(a)} / {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y or [type(v) for v in x] != [type(v) for v in y]]
    if wrong:
        return f"{len(wrong)} rows differ, first:\n   spark {str(wrong[0][0])[:600]}\n   sql   {str(wrong[0][1])[:600]}"
    return None


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    suite.load_all()
    spark = local_session()
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name, fn in suite.QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - start
            if name not in suite.ORACLES:
                print(f"rows {name} {len(rows)} {took:.1f}s", flush=True)
                continue
            cur = db.execute(suite.ORACLES[name])
            problem = compare(df.columns, rows, [d[0] for d in cur.description], cur.fetchall())
        except Exception as error:  # report and go on
            took, problem = time.time() - start, f"{type(error).__name__}: {str(error)[:1500]}"
        if problem:
            bad += 1
            print(f"FAIL {name} {took:.1f}s: {problem}", flush=True)
        else:
            print(f"ok   {name} {len(rows)} {took:.1f}s", flush=True)
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
