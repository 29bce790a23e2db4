"""Local correctness gate: every registered query against its DuckDB oracle.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__file__)))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(df):
    import pandas as pd

    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if pd.api.types.is_float_dtype(s):
            df[c] = s.map(lambda x: None if x is None or (isinstance(x, float) and math.isnan(x)) else round(x, 4))
        elif pd.api.types.is_datetime64_any_dtype(s):
            df[c] = s.astype("datetime64[us]").astype(str).where(s.notna(), None)
        else:
            df[c] = s.map(lambda x: None if x is None or (isinstance(x, float) and math.isnan(x)) else
                          (x.isoformat(sep=" ") if hasattr(x, "isoformat") else x))
    rows = [tuple(None if (isinstance(v, float) and math.isnan(v)) else v for v in r) for r in df.itertuples(index=False)]
    return list(df.columns), sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    import __spark_entry__ as E
    from stationqc.session import get_spark

    import os as _os
    if _os.environ.get("ORACLE_PLAIN"):      # a stock session, as another driver would build it
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[*]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = get_spark(extra={"spark.sql.session.timeZone": _os.environ.get("ORACLE_TZ", "UTC")})
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:2000]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in orc:
            print(f"ROWS {name}: {len(sdf)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            ddf = con.execute(orc[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:2000]}")
            bad += 1
            continue
        sc, sr = norm(sdf)
        dc, dr = norm(ddf)
        if sc != dc:
            print(f"FAIL {name}: columns {sc} vs {dc}")
            bad += 1
        elif sr != dr:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
            print(f"FAIL {name}: rows {len(sr)} vs {len(dr)}; first diffs {diff}")
            only_s = set(sr) - set(dr)
            only_d = set(dr) - set(sr)
            print("   spark-only", sorted(only_s, key=str)[:3], "duck-only", sorted(only_d, key=str)[:3])
            bad += 1
        else:
            print(f"OK   {name}: {len(sr)} rows {ts:.1f}s")
    print("failures:", bad)


if __name__ == "__main__":
    main()
