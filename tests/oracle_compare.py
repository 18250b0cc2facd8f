"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Compares row count, column names, and the multiset of rows (columns sorted by
name, floats compared after rounding to 9 significant digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _canon(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    if hasattr(v, "asDict"):
        return _canon(list(v.asDict().values()))
    return str(v)


def canon_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rows), sorted(cols)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out["duck_rows"] = len(drows)
    a, ac = canon_rows(scols, srows)
    b, bc = canon_rows(dcols, drows)
    if ac != bc:
        out["status"] = f"COLUMNS {ac} vs {bc}"
    elif a != b:
        diff = [x for x in a if x not in set(b)][:2]
        diff2 = [x for x in b if x not in set(a)][:2]
        out["status"] = "VALUES"
        out["spark_only"] = [tuple(str(v)[:120] for v in r) for r in diff]
        out["duck_only"] = [tuple(str(v)[:120] for v in r) for r in diff2]
    else:
        out["status"] = "ok"
    return out


def main():
    import __spark_entry__ as E
    from chunkwise.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, sf_dir, name, fn, sqls.get(name), con)
        except Exception as exc:  # report and continue
            r = {"name": name, "status": f"ERROR {type(exc).__name__}: {str(exc)[:400]}"}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
