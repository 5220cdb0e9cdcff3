"""Local stand-in for the driver's correctness gate: run a registered query in
Spark and its DuckDB formulation on the same parquet tables, then compare row
count, column names and an order-insensitive value hash.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.6g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6g}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return len(rows), [columns[i] for i in order], hashlib.sha256("\n".join(lines).encode()).hexdigest()


def duck(sf_dir: str, sql: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def spark_rows(df):
    rows = df.collect()
    return df.columns, [tuple(r) for r in rows]


def check(spark, sf_dir: str, name: str, fn, sql: str | None) -> dict:
    t0 = time.time()
    cols, rows = spark_rows(fn(spark, sf_dir))
    out = {"query": name, "spark_rows": len(rows), "spark_sec": round(time.time() - t0, 2)}
    if sql is None:
        out["match"] = None
        return out
    dcols, drows = duck(sf_dir, sql)
    a, b = digest(cols, rows), digest(dcols, drows)
    out.update(oracle_rows=len(drows), rows_match=a[0] == b[0], cols_match=a[1] == b[1], match=a == b)
    if a[1] != b[1]:
        out["cols"] = (a[1], b[1])
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from layerflow.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(e.queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for n in names:
        try:
            r = check(spark, sf_dir, n, qs[n], sqls.get(n))
        except Exception as ex:  # report and continue with the next query
            r = {"query": n, "error": f"{type(ex).__name__}: {str(ex)[:400]}"}
        if r.get("match") is False or "error" in r:
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
