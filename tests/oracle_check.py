"""Compare every registered query with its DuckDB SQL (also runnable as a script).

Columns are sorted by name, rows compared as a multiset, as the driver does.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted(
        (tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()), key=repr
    )


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    cols = list(rel.columns)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    data = rel.fetchall()
    return [cols[i] for i in order], sorted(
        (tuple(_norm(r[i]) for i in order) for r in data), key=repr
    )


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    s_cols, s_rows = rows_of_spark(fn(spark, sf_dir))
    t1 = time.time()
    d_cols, d_rows = rows_of_duck(con, sql)
    ok_cols = s_cols == d_cols
    ok_n = len(s_rows) == len(d_rows)
    ok_vals = s_rows == d_rows
    diff = None
    if not ok_vals:
        sa, da = set(s_rows), set(d_rows)
        diff = (list(sa - da)[:3], list(da - sa)[:3])
    return {
        "name": name,
        "cols": ok_cols,
        "rows": ok_n,
        "values": ok_vals,
        "n": len(s_rows),
        "spark_sec": round(t1 - t0, 2),
        "detail": None if ok_vals else (s_cols, d_cols, len(s_rows), len(d_rows), diff),
    }


if __name__ == "__main__":
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import duckdb
    from pyspark.sql import SparkSession

    import __spark_entry__ as E

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:] or None
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in (
        "region nation customer supplier part orders lineitem events documents "
        "embeddings pages benchmark labels conversations"
    ).split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            print(name, "no oracle")
            continue
        try:
            print(compare(spark, con, name, fn, sqls[name], sf_dir), flush=True)
        except Exception as e:  # report and continue
            print(name, "ERROR", type(e).__name__, str(e)[:800], flush=True)
