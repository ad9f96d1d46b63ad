"""Compare registered queries with their SQL twins: python tools/check.py [sf_dir] [name part ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
import numpy as np
import pandas as pd

from skyweave.queries import ORACLES, QUERIES
from skyweave.session import local_session


def duck(sf_dir: str):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype == object:
            df[c] = df[c].map(lambda v: None if v is None or v is pd.NA or (isinstance(v, float) and np.isnan(v)) else str(v))
    return df.sort_values(list(df.columns), na_position="first", kind="stable").reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} vs {sorted(want.columns)}"
    got, want = canonical(got), canonical(want)
    kinds = {c: (got[c].dtype, want[c].dtype) for c in got.columns if got[c].dtype != want[c].dtype and len(got)}
    bad = {c: k for c, k in kinds.items() if k[0].kind != k[1].kind}
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    for c in got.columns:
        a, b = got[c], want[c]
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            i = int(np.argmin(same.to_numpy()))
            return f"column {c}: {(~same).sum()} of {len(a)} differ, first {a[i]!r} vs {b[i]!r}"
    if bad:
        return f"types {bad}"
    if kinds:
        return f"note: widths {kinds}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    parts = sys.argv[2:]
    spark = local_session(8)
    con = duck(sf_dir)
    failed = 0
    for name, fn in QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        begin = time.time()
        try:
            got = fn(spark, sf_dir).toPandas()
        except Exception as e:
            failed += 1
            print(f"FAIL {name}: {str(e)[:700]}")
            continue
        took = time.time() - begin
        if name not in ORACLES:
            print(f"rows {name}: {len(got)} rows {took:.1f}s")
            continue
        try:
            want = con.execute(ORACLES[name]).df()
            diff = differences(got, want)
        except Exception as e:
            diff = f"oracle {str(e)[:500]}"
        failed += bool(diff)
        print(f"{'DIFF' if diff else 'ok  '} {name}: {len(got)} rows {took:.1f}s {diff or ''}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
