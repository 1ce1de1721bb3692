"""Run catalogue queries in Spark and their DuckDB twins; compare like the driver does
(row count, column names, order-insensitive values).

    python -m tests.oracle_harness [names...] [--sf /root/testdata/sf0.01]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if hasattr(v, "isoformat"):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r)), [cols[i] for i in order]


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    a, ac = rows_of(scols, srows)
    b, bc = rows_of(dcols, drows)
    ok = ac == bc and a == b
    info = {"name": name, "ok": ok, "rows": (len(a), len(b)), "spark_s": round(t1 - t0, 2),
            "duck_s": round(t2 - t1, 2)}
    if not ok:
        info["cols"] = (ac, bc)
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        info["only_spark"] = diff_a
        info["only_duck"] = diff_b
    return info


def main(argv):
    sf_dir = "/root/testdata/sf0.01"
    names = []
    it = iter(argv)
    for a in it:
        if a == "--sf":
            sf_dir = next(it)
        else:
            names.append(a)
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from chirpscope.session import get_spark
    spark = get_spark()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        try:
            info = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            info = {"name": name, "ok": False, "error": repr(e)[:600]}
        if info.get("ok") is False:
            bad += 1
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
