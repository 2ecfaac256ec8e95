"""Compare registered plans with their SQL.  Run: python tests/oracle.py [sf] [key ...]"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "\\N"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0) if v != int(v) or abs(v) > 1e15 else str(int(v))
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    """Empty string when equal, else what differs."""
    names, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_names, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}" if bad else ""


def main(argv):
    import __spark_entry__ as entry
    from tidewell import build_session

    sf_dir = f"/root/testdata/{argv[0] if argv else 'sf0.01'}"
    spark = build_session("oracle", 8)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = []
    wanted = []
    for pat in argv[1:] or list(queries):
        if pat.startswith("@"):
            wanted += [k for k, f in queries.items() if f.__module__.endswith("." + pat[1:])]
        else:
            wanted.append(pat)
    for key in wanted:
        start = time.time()
        try:
            df = queries[key](spark, sf_dir)
            if key in oracle:
                note = compare(df, connect(sf_dir), oracle[key])
            else:
                note = "" if df.count() else "no rows"
        except Exception as err:  # report and go on to the next key
            note = f"{type(err).__name__}: {str(err)[:700]}"
        if note:
            failed.append(key)
        print(f"{'FAIL' if note else 'ok  '} {key:28s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{len(wanted) - len(failed)} ok, {len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
