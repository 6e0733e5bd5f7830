"""Compare every registered query with its DuckDB oracle on one scale factor.

Usage: python scripts/oracle_check.py [--sf DIR] [name-substring ...]
Mirrors the driver's check: same column names (sorted), same row count, same
order-insensitive multiset of rows (floats rounded to 6 places).
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from wardline.plans.catalog import load_all  # noqa: E402
from wardline.session import build_session  # noqa: E402
from wardline.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        try:
            v = v.item()
        except Exception:
            pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return norm(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def spark_type(dt_) -> str:
    n = dt_.simpleString().upper()
    return {
        "INT": "INTEGER", "BIGINT": "BIGINT", "DOUBLE": "DOUBLE", "STRING": "VARCHAR", "DATE": "DATE",
        "BOOLEAN": "BOOLEAN", "TIMESTAMP": "TIMESTAMP", "TIMESTAMP_NTZ": "TIMESTAMP", "FLOAT": "FLOAT",
        "SMALLINT": "SMALLINT", "TINYINT": "TINYINT",
    }.get(n, n)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = build_session(master="local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    queries = load_all()
    bad = 0
    for name, q in queries.items():
        if args.names and not any(s in name for s in args.names):
            continue
        t0 = time.time()
        try:
            df = q.build(spark, args.sf)
            srows = df.collect()
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"SPARK-ERR {name}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.sql is None:
            print(f"NO-SQL   {name}: rows={len(srows)} spark={ts:.1f}s")
            continue
        try:
            cur = con.execute(q.sql)
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"DUCK-ERR {name}: {str(e)[:400]}")
            bad += 1
            continue
        stypes = {f.name: spark_type(f.dataType) for f in df.schema.fields}
        dtypes = {d[0]: str(d[1]).upper() for d in cur.description}
        tdiff = {c: (stypes.get(c), dtypes.get(c)) for c in stypes if c in dtypes and stypes[c] != dtypes[c]}
        if tdiff:
            print(f"TYPES    {name}: {tdiff}")
        if sorted(scols) != sorted(dcols):
            print(f"COLS     {name}: spark={sorted(scols)} duck={sorted(dcols)}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a == b:
            print(f"OK       {name}: rows={len(a)} spark={ts:.1f}s")
        else:
            bad += 1
            sa, sb = set(a), set(b)
            print(f"DIFF     {name}: spark_rows={len(a)} duck_rows={len(b)} cols={sorted(scols)}")
            print("   only spark:", sorted(sa - sb, key=repr)[:3])
            print("   only duck :", sorted(sb - sa, key=repr)[:3])
    print(f"failures: {bad}")
    spark.stop()


if __name__ == "__main__":
    main()
