"""Runs a registered query and its SQL counterpart and compares the rows."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


# Spark type -> SQL type; equal kinds hash alike.
KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def canonical(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def spark_rows(df):
    columns = sorted(df.columns)
    rows = df.select(*columns).collect()
    kinds = [KINDS.get(dict(df.dtypes)[c], dict(df.dtypes)[c]) for c in columns]
    return columns, kinds, sorted(tuple(canonical(v) for v in row) for row in rows)


def sql_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = [str(d[1]) for d in result.description]
    rows = result.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    return (
        [names[i] for i in order],
        [kinds[i] for i in order],
        sorted(tuple(canonical(row[i]) for i in order) for row in rows),
    )


def differences(df, con, sql):
    """Empty text if equal, else what differs first."""
    names, kinds, rows = spark_rows(df)
    other_names, other_kinds, other_rows = sql_rows(con, sql)
    if names != other_names:
        return f"columns {names} vs {other_names}"
    if kinds != other_kinds:
        return f"types {list(zip(names, kinds))} vs {other_kinds}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows vs {len(other_rows)}"
    wrong = [(a, b) for a, b in zip(rows, other_rows) if a != b]
    return f"{len(wrong)} of {len(rows)} rows differ, first {wrong[0]}" if wrong else ""
