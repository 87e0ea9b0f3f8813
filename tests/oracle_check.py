"""Spark-vs-DuckDB comparison of the registered queries.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sql: str, sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con.execute(sql).df()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        # ORACLE_EXACT=1: bit-exact doubles (what a strict value hash sees).
        return v if os.environ.get("ORACLE_EXACT") else round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    try:
        import pandas as pd
        if v is pd.NaT or (not isinstance(v, str) and pd.isna(v)):
            return None
        if isinstance(v, pd.Timestamp):
            return v.to_pydatetime().isoformat()
    except (TypeError, ValueError):
        pass
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = Counter()
    for rec in pdf[cols].itertuples(index=False, name=None):
        out[tuple(_norm(x) for x in rec)] += 1
    return cols, out


def compare(spark_df, sql: str, sf_dir: str) -> tuple[bool, str]:
    s_pdf = spark_df.toPandas()
    d_pdf = duck(sql, sf_dir)
    s_cols, s_rows = rows_of(s_pdf)
    d_cols, d_rows = rows_of(d_pdf)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    def types(pdf):
        # An integer column with nulls is float64 in one library's frames, Int64 in the other's.
        return {c: "float64" if str(t) == "Int64" and pdf[c].isna().any() else str(t)
                for c, t in pdf.dtypes.items()}
    s_types, d_types = types(s_pdf), types(d_pdf)
    if s_types != d_types:
        diff = {c: (s_types[c], d_types[c]) for c in s_types if s_types[c] != d_types[c]}
        return False, f"pandas dtypes differ (spark, duck): {diff}"
    if sum(s_rows.values()) != sum(d_rows.values()):
        return False, f"row count spark={sum(s_rows.values())} duck={sum(d_rows.values())}"
    if s_rows != d_rows:
        only_s = list((s_rows - d_rows).elements())[:3]
        only_d = list((d_rows - s_rows).elements())[:3]
        return False, f"values differ: spark-only={only_s} duck-only={only_d}"
    return True, f"{sum(s_rows.values())} rows"


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from pawprint.session import get_spark
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_spark()
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                ok, msg = compare(df, sqls[name], sf_dir)
            else:
                ok, msg = True, f"rows-only {df.count()} rows"
        except Exception as e:  # noqa: BLE001 - report and continue
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:32s} {time.time() - t:6.1f}s {msg}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
