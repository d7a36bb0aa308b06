"""Spark vs DuckDB parity for every registered query (row count, columns, values).

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(records):
    return sorted((tuple(_norm(x) for x in r) for r in records), key=lambda t: tuple((x is None, str(x)) for x in t))


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, keys=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            cols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as exc:  # noqa: BLE001
            results[k] = f"SPARK ERROR {type(exc).__name__}: {str(exc)[:300]}"
            if verbose:
                print(k, results[k], flush=True)
            continue
        if k not in sqls:
            results[k] = f"rows-only ({len(srows)} rows)"
            if verbose:
                print(f"{k}: {results[k]} {time.time()-t0:.1f}s", flush=True)
            continue
        try:
            rel = con.sql(sqls[k])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as exc:  # noqa: BLE001
            results[k] = f"DUCK ERROR {str(exc)[:300]}"
            if verbose:
                print(k, results[k], flush=True)
            continue
        status = "ok"
        if sorted(cols) != sorted(dcols):
            status = f"COLUMNS spark={cols} duck={dcols}"
        elif len(srows) != len(drows):
            status = f"ROWCOUNT spark={len(srows)} duck={len(drows)}"
        else:
            order = sorted(range(len(cols)), key=lambda i: cols[i])
            dorder = sorted(range(len(dcols)), key=lambda i: dcols[i])
            a = _rows([tuple(r[i] for i in order) for r in srows])
            b = _rows([tuple(r[i] for i in dorder) for r in drows])
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                status = f"VALUES differ e.g. {diff}"
        results[k] = status if status != "ok" else f"ok ({len(srows)} rows)"
        if verbose:
            print(f"{k}: {results[k]} {time.time()-t0:.1f}s", flush=True)
    return results


if __name__ == "__main__":
    from skyledger.session import get_session, ensure_local_checkpoint_dir
    import tempfile
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    ensure_local_checkpoint_dir(spark, tempfile.mkdtemp(prefix="skyledger-ckpt-"))
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if not (v.startswith("ok") or v.startswith("rows-only"))}
    print(f"\n{len(res) - len(bad)}/{len(res)} pass")
    for k, v in bad.items():
        print("FAIL", k, v)
