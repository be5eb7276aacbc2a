"""Run a registered query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from collections import Counter

import duckdb


def tables_db(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value:.9g}" if value else "0"
    if isinstance(value, int):
        return value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def kind(type_name: str) -> str:
    name = type_name.lower()
    for group, members in {
        "int": ("tinyint", "smallint", "int", "integer", "bigint", "long", "hugeint"),
        "float": ("float", "double", "decimal"),
        "text": ("string", "varchar"),
        "bool": ("boolean",),
        "time": ("timestamp", "date"),
    }.items():
        if name.split("(")[0].split(" ")[0].split("_")[0] in members:
            return group
    return name


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    names, got = rows_by_name(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    described = [(d[0], str(d[1])) for d in cursor.description]
    wanted_names, wanted = rows_by_name([n for n, _ in described], cursor.fetchall())
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    spark_kinds = {n: kind(t) for n, t in df.dtypes}
    duck_kinds = {n: kind(t) for n, t in described}
    if spark_kinds != duck_kinds:
        return f"types {spark_kinds} != {duck_kinds}"
    if got != wanted:
        only = list((got - wanted).items())[:3], list((wanted - got).items())[:3]
        return f"{sum(got.values())} vs {sum(wanted.values())} rows; only spark {only[0]}; only sql {only[1]}"
    return None
