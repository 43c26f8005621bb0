"""Compare a query with its SQL in DuckDB."""

import glob
import math
import os

import duckdb


def connection(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return repr(round(v, 9))
    return str([plain(x) for x in v]) if isinstance(v, (list, tuple)) else str(v)


def rows_of(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


def check(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    got = df.collect()
    assert rows_of(df.columns, got) == rows_of(columns, found.fetchall())
    return len(got)
