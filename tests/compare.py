"""Row-by-row comparison of a Spark result with the same statement in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
from collections import Counter

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def _kind(name: str) -> str:
    kinds = {
        "bigint": "bigint", "int": "integer", "string": "varchar", "double": "double",
        "date": "date", "boolean": "boolean", "timestamp_ntz": "timestamp",
    }
    return kinds.get(name, name)


def compare(spark_df, sql: str, con) -> list[str]:
    """Differences found; an empty list means equal names, types and rows."""
    found = []
    names = sorted(spark_df.columns)
    relation = con.sql(sql)
    theirs = sorted(relation.columns)
    if names != theirs:
        return [f"columns {names} != {theirs}"]
    types = dict(zip(relation.columns, [str(t).lower() for t in relation.types]))
    for field in spark_df.schema.fields:
        mine = _kind(field.dataType.simpleString())
        if mine != types[field.name]:
            found.append(f"type of {field.name}: {mine} != {types[field.name]}")
    left = Counter(tuple(_cell(v) for v in row) for row in spark_df.select(*names).collect())
    columns = ", ".join(f'"{n}"' for n in names)
    rows = con.execute(f"SELECT {columns} FROM ({sql}) AS q").fetchall()
    right = Counter(tuple(_cell(v) for v in row) for row in rows)
    if left != right:
        found.append(
            f"rows {sum(left.values())} != {sum(right.values())};"
            f" only Spark {list((left - right).items())[:3]};"
            f" only SQL {list((right - left).items())[:3]}"
        )
    return found
