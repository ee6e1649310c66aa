"""Run a registered query on Spark and its oracle SQL on DuckDB, compare.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<null>"
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if hasattr(v, "isoformat"):
        try:
            import pandas as pd
            if v is pd.NaT:
                return "<null>"
        except Exception:
            pass
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    try:
        import numpy as np
        if isinstance(v, np.ndarray):
            return "[" + ",".join(_norm(x) for x in v.tolist()) + "]"
        if isinstance(v, np.generic):
            return _norm(v.item())
    except Exception:
        pass
    return str(v)


def rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(out)


def compare(spark, con, name: str, sf_dir: str, verbose: bool = True) -> bool:
    from seqlake.oracle import ORACLE
    from seqlake.registry import QUERIES
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    sp = sdf.toPandas()
    t1 = time.time()
    if name not in ORACLE:
        print(f"{name:28s} rows={len(sp):7d} (no oracle) spark={t1-t0:.1f}s")
        return True
    od = con.sql(ORACLE[name]).df()
    t2 = time.time()
    sc, sr = rows(sp)
    oc, orr = rows(od)
    ok = sc == oc and sr == orr
    stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    print(f"{name:28s} {'OK  ' if ok else 'FAIL'} spark={len(sp):7d} duck={len(od):7d} "
          f"spark={t1-t0:.1f}s duck={t2-t1:.1f}s")
    if not ok and verbose:
        print("   cols spark:", sc, "\n   cols duck: ", oc)
        print("   spark types:", stypes, "\n   duck types:", dict(zip(od.columns, map(str, od.dtypes))))
        a, b = set(sr), set(orr)
        print("   only spark:", list(a - b)[:3])
        print("   only duck: ", list(b - a)[:3])
    return ok


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from seqlake.registry import QUERIES
    from seqlake.session import build_session
    names = argv[2:] or list(QUERIES)
    if os.environ.get("PLAIN_SESSION"):
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]")
                 .config("spark.sql.session.timeZone", os.environ.get("PLAIN_TZ", "America/Los_Angeles"))
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    bad = [n for n in names if not compare(spark, con, n, sf_dir)]
    print("FAILED:", bad if bad else "none")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
