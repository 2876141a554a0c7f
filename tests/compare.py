"""Run registered queries and their SQL side by side: ``python -m tests.compare [sf] [name ...]``."""

import math
import sys
import time

import duckdb

from __spark_entry__ import oracle_sql, queries
from roadflow.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v + 0.0)
    return None if v is None else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(norm(r[i]) for i in order) for r in rows), key=str)


def duck_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([c[0] for c in cur.description], cur.fetchall())


def compare(spark, con, name, d):
    started = time.time()
    df = queries()[name](spark, d)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    sql = oracle_sql().get(name)
    if sql is None:
        return f"rows only ({len(got[1])})", took, True
    want = duck_rows(con, sql)
    if got == want:
        return f"ok ({len(got[1])} rows)", took, True
    a, b = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
    note = f"DIFF columns {got[0]} / {want[0]}; rows {len(got[1])} / {len(want[1])}; spark only {len(a)}: {sorted(a, key=str)[:3]}; sql only {len(b)}: {sorted(b, key=str)[:3]}"
    return note, took, False


def connect(d):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    return con


def main(argv):
    sf = argv[0] if argv else "0.001"
    names = argv[1:] or list(queries())
    d = f"/root/testdata/sf{sf}"
    spark = local_session(8, "compare")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(d), 0
    for name in names:
        try:
            note, took, good = compare(spark, con, name, d)
        except Exception as e:  # noqa: BLE001
            note, took, good = f"ERROR {type(e).__name__}: {str(e)[:700]}", 0.0, False
        bad += not good
        print(f"{name:32s} {took:6.2f}s {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main(sys.argv[1:])
