"""Run registered queries on Spark and their SQL twins on DuckDB and compare.

    python -m tests.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp", "TIMESTAMP_NTZ": "timestamp",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canon(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return 0.0 if value == 0 else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(canon(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, entry, sf_dir) -> tuple[bool, str]:
    df = entry.build(spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    if entry.sql is None:
        return True, f"{len(spark_rows)} rows, no SQL twin"
    cur = con.execute(entry.sql)
    names = [d[0] for d in cur.description]
    types = {n: str(t) for n, t in zip(names, [d[1] for d in cur.description])}
    duck_rows = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns differ: {sorted(df.columns)} / {sorted(names)}"
    bad = []
    for field in df.schema.fields:
        want = TYPES.get(types[field.name].upper(), types[field.name])
        have = field.dataType.simpleString().replace("timestamp_ntz", "timestamp")
        if want != have:
            bad.append(f"{field.name} {have}/{want}")
    if bad:
        return False, "types differ: " + ", ".join(bad)
    left, right = rows_of(df.columns, spark_rows), rows_of(names, duck_rows)
    if len(left) != len(right):
        return False, f"row counts differ: {len(left)} / {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            n = sum(x != y for x, y in zip(left, right))
            return False, f"{n} rows differ, first: {sorted(df.columns)}\n   {a}\n   {b}"
    if not left:
        return False, "no rows"
    return True, f"{len(left)} rows equal"


def main() -> int:
    from staffflow.plans import load_all
    from staffflow.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    registry = load_all()
    names = sys.argv[2:] or list(registry)
    spark, con = local_session(), connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, con, registry[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{len(names) - failed} of {len(names)} fine")
    return failed


if __name__ == "__main__":
    sys.exit(main())
