"""Compare every registered query with its DuckDB oracle (what the driver's
verify does): row count, column names, order-insensitive value hash.

Run as a script: ``python tests/oracle_check.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[list[str], int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [columns[i] for i in order], len(rows), h, lines


def spark_rows(df):
    cols = df.columns
    return cols, [tuple(r) for r in df.collect()]


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as E

    qs = E.queries()
    sql = E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            scols, srows = spark_rows(qs[name](spark, sf_dir))
        except Exception as ex:  # pragma: no cover - reported
            results[name] = ("spark-error", str(ex)[:400])
            if verbose:
                print(f"{name:28s} SPARK ERROR {str(ex)[:400]}")
            continue
        ts = time.time() - t0
        if name not in sql:
            results[name] = ("rows-only", len(srows))
            if verbose:
                print(f"{name:28s} rows-only {len(srows)}")
            continue
        try:
            cur = con.execute(sql[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as ex:
            results[name] = ("sql-error", str(ex)[:400])
            if verbose:
                print(f"{name:28s} SQL ERROR {str(ex)[:400]}")
            continue
        a = digest(scols, srows)
        b = digest(dcols, drows)
        ok = a[0] == b[0] and a[1] == b[1] and a[2] == b[2]
        results[name] = ("ok" if ok else "MISMATCH", a[1], b[1])
        if verbose:
            print(f"{name:28s} {'ok' if ok else 'MISMATCH'} spark={a[1]} duck={b[1]} {ts:.1f}s")
            if not ok:
                if a[0] != b[0]:
                    print("   cols spark:", a[0])
                    print("   cols duck: ", b[0])
                else:
                    sa, sb = set(a[3]), set(b[3])
                    for x in sorted(sa - sb)[:3]:
                        print("   only spark:", x[:300])
                    for x in sorted(sb - sa)[:3]:
                        print("   only duck: ", x[:300])
    return results


if __name__ == "__main__":
    from culedger.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", 8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("ok", "rows-only")}
    print(f"{len(res) - len(bad)}/{len(res)} pass; failing: {sorted(bad)}")
