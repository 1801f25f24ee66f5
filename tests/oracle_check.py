"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Mirrors the driver's gate: same column names, same row count, same multiset
of rows (columns sorted by name). Usage:

    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer():
            return int(v)
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out, key=repr)


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame):
    sc, sr = rows_of(spark_pdf)
    dc, dr = rows_of(duck_pdf)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} duck={len(dr)}"
    for a, b in zip(sr, dr):
        if repr(a) != repr(b):
            return False, f"first diff:\n  spark={a}\n  duck ={b}"
    return True, f"{len(sr)} rows"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from quarry.session import build_session
    spark = build_session()
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(qs):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir).toPandas()
        except Exception as exc:
            print(f"FAIL {k}: spark error {type(exc).__name__}: {str(exc)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in orc:
            print(f"ROWS {k}: {len(sdf)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            ddf = con.execute(orc[k]).fetchdf()
        except Exception as exc:
            print(f"FAIL {k}: duckdb error {str(exc)[:400]}")
            bad += 1
            continue
        ok, msg = compare(sdf, ddf)
        bad += 0 if ok else 1
        print(f"{'OK  ' if ok else 'FAIL'} {k}: {msg} {ts:.1f}s")
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
