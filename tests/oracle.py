"""Spark rows against DuckDB rows, columns by name, rows in any order."""

import datetime
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return str(v)


def rows(names, values):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return [names[k] for k in order], sorted(tuple(plain(r[k]) for k in order) for r in values)


def compare(df, con, sql):
    """(equal, what differs)."""
    spark_names, spark_rows = rows(df.columns, df.collect())
    cursor = con.execute(sql)
    duck_names, duck_rows = rows([d[0] for d in cursor.description], cursor.fetchall())
    if spark_names != duck_names:
        return False, (spark_names, duck_names)
    if spark_rows != duck_rows:
        a, b = set(spark_rows), set(duck_rows)
        return False, (len(spark_rows), len(duck_rows), sorted(a - b)[:2], sorted(b - a)[:2])
    return True, len(spark_rows)
