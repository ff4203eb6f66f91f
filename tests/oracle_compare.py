"""Run registered queries in Spark and their oracle SQL in DuckDB and compare
row count, column names and values (order-insensitive)."""

from __future__ import annotations

import datetime as dt
import math
import sys

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


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
            return "NaN"
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


# Spark type -> DuckDB type of the same values.
TYPE_NAMES = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
              "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN", "DateType()": "DATE",
              "TimestampNTZType()": "TIMESTAMP", "TimestampType()": "TIMESTAMP WITH TIME ZONE"}


def compare(spark, con, name, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: TYPE_NAMES.get(str(f.dataType), str(f.dataType)) for f in sdf.schema.fields}
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in sdf.collect()]
    typed = con.sql(sql)
    d_types = {c: str(t) for c, t in zip(typed.columns, typed.types)}
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_raw = rel.fetchall()
    order = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    d_rows = [tuple(_norm(r[i]) for i in order) for r in d_raw]
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns {sorted(s_cols)} != {sorted(d_cols)}")
    type_diff = {c: (s_types.get(c), d_types.get(c)) for c in set(s_types) | set(d_types)
                 if s_types.get(c) != d_types.get(c)}
    if type_diff:
        problems.append(f"types {type_diff}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows {len(s_rows)} != {len(d_rows)}")
    def key(r):
        fixed = tuple((x is None, str(x)) for x in r if not isinstance(x, float))
        return fixed + tuple((x is None, str(x)) for x in r if isinstance(x, float))
    a, b = sorted(s_rows, key=key), sorted(d_rows, key=key)
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        problems.append(f"{len(diff)} differing rows, e.g. {diff[:3]}")
    return problems


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as e
    from stratus.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf)
    qs, os_ = e.queries(), e.oracle_sql()
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in os_:
            n = fn(spark, sf).count()
            print(f"{name:28s} rows-only {n}")
            continue
        try:
            p = compare(spark, con, name, fn, os_[name], sf)
        except Exception as exc:  # report and go on
            p = [f"ERROR {type(exc).__name__}: {str(exc)[:400]}"]
        print(f"{name:28s} {'OK' if not p else 'FAIL ' + ' | '.join(p)}", flush=True)
