"""Compare registered queries with their DuckDB SQL: python tests/oracle_check.py [sf] [keys]."""

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = "nation customer part orders lineitem".split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def compare(df, con, sql):
    """None when both sides agree, else a short description of the difference."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    want = [tuple(row[names.index(c)] for c in order) for row in found.fetchall()]
    got = [tuple(row[c] for c in order) for row in df.collect()]

    def by_value(row):
        return tuple((v is None, str(type(v)) if v is None else "", v if v is not None else 0)
                     if not isinstance(v, float) else (False, "", v) for v in row)

    if len(want) != len(got):
        return f"rows {len(got)} != {len(want)}"
    want.sort(key=by_value)
    got.sort(key=by_value)
    unequal = [(g, w) for g, w in zip(got, want) if g != w]
    if not unequal:
        return None
    near = all(len(g) == len(w) and all(
        a == b or (isinstance(a, float) and isinstance(b, float)
                   and math.isclose(a, b, rel_tol=1e-12)) for a, b in zip(g, w))
        for g, w in unequal)
    return f"{len(unequal)} of {len(want)} rows differ{' in the last digits' if near else ''}: " \
           f"{order} {unequal[0]}"


if __name__ == "__main__":
    import __spark_entry__ as e
    from tests.conftest import make_session

    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark = make_session()
    con = connect(sf_dir)
    sql = e.oracle_sql()
    keys = sys.argv[2:] or list(e.queries())
    for key in keys:
        start = time.time()
        try:
            df = e.queries()[key](spark, sf_dir)
            if key in sql:
                outcome = compare(df, con, sql[key]) or "same"
            else:
                outcome = f"{df.count()} rows"
        except Exception as error:  # noqa: BLE001
            outcome = f"ERROR {type(error).__name__} {str(error)[:600]}"
        print(f"{key:26s} {time.time() - start:6.1f}s {outcome}", flush=True)
