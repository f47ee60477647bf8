"""Run registered queries with Spark and their oracle SQL with DuckDB and
compare row count, column names and an order-insensitive value hash.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN"}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if hasattr(v, "is_finite"):  # Decimal
        return repr(round(float(v), 6))
    return str(v)


def table_hash(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def duck_con(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def run(sf_dir, names=None, spark=None):
    import __spark_entry__ as entry
    from utxoflow.session import get_spark

    spark = spark or get_spark()
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck_con(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                      for f in df.schema.fields}
            rows = [tuple(r) for r in df.collect()]
            t_spark = time.time() - t0
        except Exception as e:  # noqa: BLE001
            results[name] = {"ok": False, "error": f"spark: {type(e).__name__}: {str(e)[:400]}"}
            print(name, results[name], flush=True)
            continue
        if name not in sqls:
            results[name] = {"ok": None, "rows": len(rows), "spark_s": round(t_spark, 2)}
            print(name, results[name], flush=True)
            continue
        try:
            rel = con.sql(sqls[name])
            otypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
            cur = con.execute(sqls[name])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = {"ok": False, "error": f"duckdb: {str(e)[:400]}"}
            print(name, results[name], flush=True)
            continue
        ok_cols = sorted(cols) == sorted(ocols)
        ok_types = ok_cols and all(stypes[c] == otypes.get(c) for c in cols)
        h1 = table_hash(cols, rows)
        h2 = table_hash(ocols, orows)
        res = {"ok": ok_cols and ok_types and len(rows) == len(orows) and h1 == h2, "rows": len(rows),
               "oracle_rows": len(orows), "cols_match": ok_cols, "types_match": ok_types, "hash_match": h1 == h2,
               "spark_s": round(t_spark, 2)}
        if not ok_cols:
            res["cols"] = (sorted(cols), sorted(ocols))
        elif not ok_types:
            res["types"] = {c: (stypes[c], otypes.get(c)) for c in cols if stypes[c] != otypes.get(c)}
        if not res["ok"] and ok_cols:
            order = sorted(range(len(cols)), key=lambda i: cols[i])
            oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
            a = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
            b = sorted("|".join(_norm(r[i]) for i in oorder) for r in orows)
            sa, sb = set(a), set(b)
            res["only_spark"] = sorted(sa - sb)[:3]
            res["only_oracle"] = sorted(sb - sa)[:3]
        results[name] = res
        print(name, res, flush=True)
    return results


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    out = run(sf, names)
    bad = [k for k, v in out.items() if v.get("ok") is False]
    print("FAILED:", bad)
    print(f"{sum(1 for v in out.values() if v.get('ok'))}/{len(out)} match")
