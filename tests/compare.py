"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    """Column names in order, and the rows sorted, with values in a comparable form."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def spark_types(df):
    names = {"string": "varchar", "int": "integer"}
    return {f.name: names.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}


def duck_types(con, sql):
    return {row[0]: row[1].lower() for row in con.execute(f"DESCRIBE {sql}").fetchall()}
