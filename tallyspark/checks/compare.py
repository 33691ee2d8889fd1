"""Local Spark-vs-DuckDB comparison (row count, column names, and an
order-insensitive hash of values), used by the tests."""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int = int(__import__("os").environ.get("ORACLE_DIGITS", "9"))):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.{digits}g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.{digits}g}")
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    return v


def rows_hash(cols: list[str], rows) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    digests = sorted(hashlib.sha1(repr(tuple(_norm(r[i]) for i in order)).encode()).hexdigest() for r in rows)
    return len(digests), hashlib.sha1("".join(digests).encode()).hexdigest()


def compare(spark_df, con, sql: str) -> dict:
    srows = spark_df.collect()
    scols = spark_df.columns
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out = {"spark_rows": len(srows), "oracle_rows": len(drows),
           "columns_match": sorted(scols) == sorted(dcols)}
    if out["columns_match"]:
        out["hash_match"] = rows_hash(scols, srows) == rows_hash(dcols, drows)
        if not out["hash_match"]:
            order_s = sorted(range(len(scols)), key=lambda i: scols[i])
            order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
            s = sorted(repr(tuple(_norm(r[i]) for i in order_s)) for r in srows)
            d = sorted(repr(tuple(_norm(r[i]) for i in order_d)) for r in drows)
            only_s = sorted(set(s) - set(d))[:3]
            only_d = sorted(set(d) - set(s))[:3]
            out["columns"] = sorted(scols)
            out["only_spark"] = only_s
            out["only_oracle"] = only_d
    else:
        out["spark_columns"] = sorted(scols)
        out["oracle_columns"] = sorted(dcols)
    return out
