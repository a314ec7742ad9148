"""Spark-vs-DuckDB comparison in the way the driver does it: same row count,
same column names, same multiset of rows (columns sorted by name)."""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in row) for row in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def compare(spark_df, con, sql: str) -> dict:
    t0 = time.time()
    s = spark_df.toPandas()
    t1 = time.time()
    rel = con.sql(sql)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    d = rel.df()
    res = {"spark_rows": len(s), "oracle_rows": len(d), "spark_sec": round(t1 - t0, 2)}
    res["type_diffs"] = {c: (t, duck_types.get(c)) for c, t in spark_df.dtypes
                         if SPARK_TO_DUCK.get(t, t) != duck_types.get(c)}
    res["columns_match"] = sorted(s.columns) == sorted(d.columns)
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = sorted(s.columns), sorted(d.columns)
        res["ok"] = False
        return res
    rs, rd = _rows(s), _rows(d)
    res["values_match"] = rs == rd
    if not res["values_match"]:
        diff = [(a, b) for a, b in zip(rs, rd) if a != b][:3]
        res["first_diffs"] = diff
    res["ok"] = res["values_match"] and len(s) == len(d) and not res["type_diffs"]
    return res


def main(sf_dir: str = "/root/testdata/sf0.01", only: list[str] | None = None) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tabflow.session import local_session
    spark = local_session("8")
    con = duck(sf_dir)
    qs, sq = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sq:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"{name:24s} rows-only {n} rows {time.time() - t0:.1f}s")
            continue
        try:
            r = compare(fn(spark, sf_dir), con, sq[name])
        except Exception as e:  # noqa: BLE001
            r = {"ok": False, "error": repr(e)[:400]}
        bad += not r["ok"]
        print(f"{name:24s} {'OK ' if r['ok'] else 'BAD'} {r}")
    return bad


if __name__ == "__main__":
    sys.exit(main(*(sys.argv[1:2] or []), only=sys.argv[2:] or None))
