"""Run a registered query and its SQL twin, and compare them as sorted rows."""

from __future__ import annotations

import datetime
import glob
import os

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(value):
    if value is None:
        return "~null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "~nan" if value != value else repr(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return str(value)


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple(canonical(r[c]) for c in columns) for r in df.collect())


def sql_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    columns = sorted(names)
    at = [names.index(c) for c in columns]
    return columns, sorted(tuple(canonical(r[i]) for i in at) for r in cur.fetchall())


def difference(df, con, sql) -> str | None:
    left_columns, left = spark_rows(df)
    right_columns, right = sql_rows(con, sql)
    if left_columns != right_columns:
        return f"columns {left_columns} != {right_columns}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    wrong = [(a, b) for a, b in zip(left, right, strict=True) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(left)} rows differ, first {left_columns}: {wrong[0][0]} != {wrong[0][1]}"
    return None
