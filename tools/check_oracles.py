"""Run queries against their checking SQL: ``python tools/check_oracles.py [sf] [names]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark import catalog
from tidemark.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].map(lambda v: repr(float(v)))
        else:
            df[c] = df[c].map(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def compare(spark, directory: str, name: str, fn, sql: str | None) -> tuple[bool, str]:
    started = time.time()
    got = fn(spark, directory).toPandas()
    took = time.time() - started
    if sql is None:
        return True, f"rows={len(got)} (no SQL) {took:.1f}s"
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{directory}/{table}.parquet'")
    want = con.execute(sql).fetchdf()
    if sorted(got.columns) != sorted(want.columns):
        return False, f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    kinds = [(c, got[c].dtype, want[c].dtype) for c in got.columns if got[c].dtype.kind != want[c].dtype.kind]
    a, b = canonical(got), canonical(want)
    if len(a) != len(b):
        return False, f"rows {len(a)} != {len(b)}"
    if not a.equals(b):
        bad = (a != b).any(axis=1)
        return False, f"{int(bad.sum())} of {len(a)} rows differ\n{a[bad].head(3).to_string()}\n{b[bad].head(3).to_string()}"
    return True, f"rows={len(a)} {took:.1f}s" + (f" kinds {kinds}" if kinds else "")


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    wanted = sys.argv[2:]
    spark = local_session("8", "check")
    queries, oracles = catalog.queries(), catalog.oracles()
    failed = 0
    for name, fn in queries.items():
        if wanted and name not in wanted:
            continue
        try:
            ok, note = compare(spark, f"/root/testdata/{sf}", name, fn, oracles.get(name))
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failed:", failed, "of", len(wanted or queries))
    return failed


if __name__ == "__main__":
    sys.exit(main())
