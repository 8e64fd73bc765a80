"""Run Spark queries and their DuckDB oracle side by side and compare results.

Usage: python tests/oracle_check.py [sf_dir] [query-name-substring ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from gridloom.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v == int(v) and abs(v) < 2**53:
            return str(int(v))
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, pd.Timestamp):
        return str(v)
    return str(v)


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    df = df[cols]
    return sorted(tuple(_norm(v) for v in r) for r in df.itertuples(index=False, name=None))


def duck(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(base) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, base: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(base)
    out = {}
    for name, fn in qs.items():
        if names and not any(n in name for n in names):
            continue
        t0 = time.time()
        sdf = fn(spark, base).toPandas()
        t1 = time.time()
        if name not in sqls:
            out[name] = ("rows-only", len(sdf))
            if verbose:
                print(f"{name:40s} rows-only  spark_rows={len(sdf)}  {t1 - t0:.1f}s", flush=True)
            continue
        odf = con.execute(sqls[name]).df()
        status = "ok"
        if sorted(sdf.columns) != sorted(odf.columns):
            status = f"COLUMNS spark={sorted(sdf.columns)} oracle={sorted(odf.columns)}"
        else:
            a, b = rows_of(sdf), rows_of(odf)
            if len(a) != len(b):
                status = f"ROWCOUNT spark={len(a)} oracle={len(b)}"
            elif a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                status = f"VALUES first diffs: {diff}"
        out[name] = (status, len(sdf))
        if verbose:
            print(f"{name:40s} {status[:400]}  rows={len(sdf)}  {t1 - t0:.1f}s", flush=True)
    return out


if __name__ == "__main__":
    from gridloom.session import build_session

    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    res = compare(spark, base, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("ok", "rows-only")]
    print("FAILED:", bad if bad else "none")
