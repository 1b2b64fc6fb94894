"""Run registered queries next to their SQL twins: ``python tests/compare.py [folder] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, every value as text, rows in order."""
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        def text(v):
            if v is None or (isinstance(v, float) and np.isnan(v)) or v is pd.NA or v is pd.NaT:
                return "NULL"
            if isinstance(v, (float, np.floating)):
                return repr(float(v) + 0.0)
            if isinstance(v, (bool, np.bool_)):
                return str(bool(v))
            return str(v)

        df[c] = [text(v) for v in df[c].astype(object)]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None if equal, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    kinds = [(c, str(got[c].dtype), str(want[c].dtype)) for c in got if len(got) and got[c].notna().all()
             and str(got[c].dtype)[:3] != str(want[c].dtype)[:3] and {str(got[c].dtype)[0], str(want[c].dtype)[0]} & {"i", "f"}]
    if kinds:
        return f"types {kinds}"
    a, b = normal(got), normal(want)
    bad = (a != b).any(axis=1)
    if bad.any():
        return f"{bad.sum()} rows differ:\n{a[bad].head(3).to_string()}\n{b[bad].head(3).to_string()}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from tessera.runtime import build_session

    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("compare", "8")
    con = duck(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = []
    for name in args[1:] or queries:
        start = time.time()
        try:
            got = queries[name](spark, folder).toPandas()
            took = time.time() - start
            if name not in oracles:
                print(f"rows  {name} {len(got)} {took:.1f}s", flush=True)
                continue
            start = time.time()
            why = difference(got, con.execute(oracles[name]).df())
            print(f"{'ok  ' if why is None else 'DIFF'}  {name} {len(got)} {took:.1f}s sql {time.time() - start:.1f}s", flush=True)
        except Exception as error:  # noqa: BLE001
            why = f"{type(error).__name__}: {str(error)[:1500]}"
            print(f"FAIL  {name}", flush=True)
        if why:
            failed.append(name)
            print(why, flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
