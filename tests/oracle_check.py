"""Run registered queries in Spark and their SQL in DuckDB; compare row count, columns and values.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""
from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from textsift.session import TABLES  # noqa: E402


def normalise(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(normalise(x) for x in v)
    if hasattr(v, "item"):
        return normalise(v.item())
    return v


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duckdb.connect()
    for t in TABLES + ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    out = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            cols = sorted(sdf.columns)
            srows = [tuple(normalise(r[c]) for c in cols) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            out[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, out[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            out[name] = f"rows-only {len(srows)}"
            print(f"{name:32s} rows-only n={len(srows)} spark={ts:.1f}s", flush=True)
            continue
        try:
            rel = con.execute(sqls[name])
            dcols = [d[0] for d in rel.description]
            drows_raw = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            out[name] = f"SQL ERROR {str(e)[:300]}"
            print(name, out[name], flush=True)
            continue
        order = sorted(range(len(dcols)), key=lambda i: dcols[i])
        drows = [tuple(normalise(r[i]) for i in order) for r in drows_raw]
        ok_cols = sorted(dcols) == cols
        key = lambda r: tuple((x is None, str(type(x)), str(x)) for x in r)
        a, b = sorted(srows, key=key), sorted(drows, key=key)
        ok = ok_cols and a == b
        out[name] = "OK" if ok else "MISMATCH"
        print(f"{name:32s} {out[name]} n={len(srows)}/{len(drows)} cols={'ok' if ok_cols else (cols, sorted(dcols))} "
              f"spark={ts:.1f}s", flush=True)
        if not ok and verbose and ok_cols:
            sa, sb = set(a), set(b)
            print("   spark-only:", sorted(sa - sb, key=key)[:4])
            print("   sql-only:  ", sorted(sb - sa, key=key)[:4])
    return out


if __name__ == "__main__":
    from textsift.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    compare(local_session(), sf, sys.argv[2:] or None)
