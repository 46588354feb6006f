"""Run registered queries in Spark and their oracle SQL in DuckDB and
compare: row count, column names, and order-insensitive values (floats
compared after rounding to 6 significant decimals)."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    con.execute("SET TimeZone='UTC'")
    return con


EXACT = False

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "timestamp": "TIMESTAMP"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0 if EXACT else round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, name, fn, sql, sf_dir, con):
    t = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t
    if sql is None:
        return {"name": name, "ok": None, "rows": len(s_rows), "sec": ts}
    d_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    bad_types = {k: (v, d_types.get(k)) for k, v in s_types.items() if d_types.get(k) != v}
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    info = {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows), "sec": round(ts, 2)}
    if sorted(s_cols) != sorted(d_cols):
        info.update(ok=False, why=f"columns {sorted(s_cols)} vs {sorted(d_cols)}")
        return info
    if bad_types:
        info.update(ok=False, why=f"column types differ: {bad_types}")
        return info
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        diff = next(((x, y) for x, y in zip(a, b) if x != y), None)
        info.update(ok=False, why=f"values differ, first: {diff}")
        return info
    info["ok"] = True
    return info


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from __spark_entry__ import oracle_sql, queries
    from pitchlake.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2].split(",") if len(sys.argv) > 2 and sys.argv[2] != "all" else None
    EXACT = "--exact" in sys.argv
    spark = get_spark("local[8]", 8)
    con = duck(sf)
    sqls = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, name, fn, sqls.get(name), sf, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:600]}"}
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print("FAILED", bad)
