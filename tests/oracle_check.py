"""Run registered Spark queries next to their DuckDB oracle and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and the multiset of rows (columns sorted by
name).  Doubles are compared exactly and, as a fallback, to 1e-9 relative so a
report can tell "exact" from "close".
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    return v


def _rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


def _close(a, b):
    if len(a) != len(b):
        return False
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if isinstance(x, float) and isinstance(y, float):
                if not math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9):
                    return False
            elif isinstance(x, (int, float)) and isinstance(y, (int, float)):
                if not math.isclose(float(x), float(y), rel_tol=1e-9, abs_tol=1e-9):
                    return False
            elif x != y:
                return False
    return True


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    res["duck_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        res["status"] = "SCHEMA"
        res["detail"] = f"spark-only={sorted(set(scols) - set(dcols))} duck-only={sorted(set(dcols) - set(scols))}"
        return res
    a, b = _rows(scols, srows), _rows(dcols, drows)
    if a == b:
        res["status"] = "exact"
    elif _close(a, b):
        res["status"] = "close"
    else:
        res["status"] = "MISMATCH"
        for ra, rb in zip(a, b):
            if ra != rb:
                names = sorted(scols)
                res["detail"] = str([(names[i], x, y) for i, (x, y) in enumerate(zip(ra, rb)) if x != y][:6])
                break
        else:
            res["detail"] = "row counts differ"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from roasline.session import get_spark

    spark = get_spark("local[8]")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as exc:  # report and continue
            r = {"name": name, "status": "ERROR", "detail": repr(exc)[:400]}
        bad += r["status"] not in ("exact", "close", "rows-only")
        print(r, flush=True)
    print(f"failures: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
