"""Run the registered queries next to their DuckDB statements.

python tests/compare.py [sf] [name ...]
"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dict):
        return repr(sorted(v.items()))
    return repr(v)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, query, sql):
    """None when equal, else a text saying what differs."""
    df = query(spark, sf_dir)
    have_cols, have = normalised(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = normalised([d[0] for d in cur.description], cur.fetchall())
    if have_cols != want_cols:
        return f"columns {have_cols} != {want_cols}"
    if have != want:
        a, b = set(have), set(want)
        return f"{len(have)} rows != {len(want)}; spark only {sorted(a - b)[:3]}; duckdb only {sorted(b - a)[:3]}"
    return None


def main():
    import __spark_entry__ as entry
    from skeinmart.session import local_session

    args = sys.argv[1:]
    sf_dir = f"/root/testdata/{args[0] if args else 'sf0.01'}"
    spark, con = local_session(8), oracle(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args[1:] or queries:
        start = time.time()
        try:
            wrong = compare(spark, con, sf_dir, name, queries[name], sqls[name])
        except Exception as e:  # report and go on with the next query
            wrong = f"{type(e).__name__}: {str(e)[:600]}"
        bad += wrong is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if wrong is None else 'DIFF ' + wrong}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
