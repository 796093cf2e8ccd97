"""Run every registered query in Spark and its oracle in DuckDB; compare.

Usage: python scripts/check_oracle.py [sf_dir] [name-substring ...]
Prints one line per query and a summary. Exit code 1 on any mismatch.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from ratings_engine.config import build_session  # noqa: E402
from ratings_engine.plans.registry import all_queries, render_sql  # noqa: E402

DIGITS = int(os.environ.get("ORACLE_DIGITS", "6"))   # float digits compared

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, DIGITS) + 0.0
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    bad = 0
    n = 0
    for name, q in all_queries().items():
        if pats and not any(p in name for p in pats):
            continue
        n += 1
        t0 = time.time()
        try:
            sdf = q.build(spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.sql is None:
            print(f"ROWS {name}: {len(sdf)} rows ({ts:.1f}s)")
            continue
        try:
            odf = con.execute(render_sql(q.sql)).fetchdf()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:300]}")
            bad += 1
            continue
        sd = {c: str(t) for c, t in sdf.dtypes.items()}
        od = {c: str(t) for c, t in odf.dtypes.items()}
        dt_diff = {c: (sd[c], od.get(c)) for c in sd if c in od and sd[c] != od[c]}
        if dt_diff:
            print(f"DTYPE {name}: {dt_diff}")
        sc, sr = canon(sdf)
        oc, orr = canon(odf)
        if sc != oc:
            print(f"FAIL {name}: columns spark={sc} oracle={oc}")
            bad += 1
        elif len(sr) != len(orr):
            print(f"FAIL {name}: rows spark={len(sr)} oracle={len(orr)}")
            bad += 1
        elif sr != orr:
            diff = [(a, b) for a, b in zip(sr, orr) if a != b][:3]
            print(f"FAIL {name}: values differ, e.g. {diff}")
            bad += 1
        else:
            print(f"OK   {name}: {len(sr)} rows ({ts:.1f}s)")
    print(f"{n - bad}/{n} passed")
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
