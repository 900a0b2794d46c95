"""Side-by-side check of ``queries()`` against ``oracle_sql()`` on DuckDB.

Used by ``tests/test_oracle.py`` and runnable by hand:
``python tests/oracle.py /root/testdata/sf0.01 [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    """Exact comparison: doubles by their shortest repr, decimals by value.

    No registered query sums doubles (only max / min / max_by and exact
    decimal arithmetic), so both engines must agree to the last bit.
    """
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir: str, name: str, fn, sql: str, con) -> tuple[bool, str]:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duckdb={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duckdb={len(d_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({len(s_rows)} rows), e.g. {diff}"
    return True, f"{len(s_rows)} rows"


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from tickwise.session import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    spark = get_session(master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    oracles = E.oracle_sql()
    bad = 0
    for n in names:
        fn = E.queries()[n]
        if n not in oracles:
            cnt = fn(spark, sf_dir).count()
            print(f"{n:24s} rows-only {cnt}")
            continue
        try:
            ok, msg = compare(spark, sf_dir, n, fn, oracles[n], con)
        except Exception as e:  # report and go on
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{n:24s} {'OK  ' if ok else 'FAIL'} {msg}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
