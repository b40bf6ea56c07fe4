"""Compare registered queries with DuckDB over the same tables."""

from __future__ import annotations

import math
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _sorted(rows):
    return sorted((tuple(map(_plain, r)) for r in rows), key=repr)


def compare(spark, con, name, query, sql, sf_dir):
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    got = _sorted(tuple(r[c] for c in order) for r in df.collect())
    index = [names.index(c) for c in order]
    want = _sorted(tuple(r[i] for i in index) for r in cur.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"{g} != {w}"
    return None if got else "no rows"


if __name__ == "__main__":
    import os
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from jsonflow.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf), entry.oracle_sql(), 0
    for name, q in entry.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            if name in oracles:
                diff = compare(spark, con, name, q, oracles[name], sf)
            else:
                diff = None if q(spark, sf).count() else "no rows"
        except Exception as e:  # show every failure, not only the first
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(diff)
        print(f"{name:28s} {time.time() - t:6.2f}s {'ok' if not diff else 'DIFF ' + diff}", flush=True)
    print("failed:", bad)
