"""Run ``queries()`` against ``oracle_sql()`` on one scale factor.

Compares row count, column names and an order-insensitive multiset of
normalised rows (floats rounded to 6 places).  Usable as a script:

    python tests/oracle_compare.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def _rows(cols, tuples):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(t[i]) for i in order) for t in tuples), key=repr)


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf: str, keys=None, verbose=True) -> dict:
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf)
    out = {}
    for k in keys or list(qs):
        t = time.time()
        try:
            df = qs[k](spark, sf)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
            el = time.time() - t
            if k not in sqls:
                out[k] = {"ok": None, "rows": len(srows), "sec": el}
                continue
            res = con.execute(sqls[k])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
            ok_cols = sorted(scols) == sorted(dcols)
            ok = ok_cols and len(srows) == len(drows) and _rows(scols, srows) == _rows(dcols, drows)
            info = {"ok": ok, "rows": len(srows), "oracle_rows": len(drows), "sec": round(el, 2)}
            if not ok:
                info["cols"] = (scols, dcols)
                a, b = _rows(scols, srows), _rows(dcols, drows)
                info["diff"] = ([x for x in a if x not in b][:3], [x for x in b if x not in a][:3])
        except Exception as exc:  # report and go on
            info = {"ok": False, "error": repr(exc)[:800]}
        out[k] = info
        if verbose:
            print(k, info, flush=True)
    return out


if __name__ == "__main__":
    from shardsmith.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v.get("ok") is False]
    print("FAILED:", bad)
    print("passed", sum(1 for v in res.values() if v.get("ok")), "of", len(res))
