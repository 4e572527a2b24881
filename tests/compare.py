"""Run a query and its SQL on the same files and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if value is None:
        return ("", "null")
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, float):
        return ("f", "nan" if math.isnan(value) else repr(value))
    if isinstance(value, (list, tuple)):
        return ("l", tuple(_cell(v) for v in value))
    if isinstance(value, int):
        return ("i", value)
    return (type(value).__name__, str(value))


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted((tuple(_cell(v) for v in row) for row in zip(*columns)), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Empty when both sides hold the same columns, kinds of values and rows."""
    left = df.toArrow()
    right = con.execute(sql).to_arrow_table()
    names, mine = _rows(left)
    other, theirs = _rows(right)
    found = []
    if names != other:
        return [f"columns {names} against {other}"]
    for n in names:
        a, b = str(left.schema.field(n).type), str(right.schema.field(n).type)
        if a.replace("large_", "") != b.replace("large_", ""):
            found.append(f"type of {n}: {a} against {b}")
    if len(mine) != len(theirs):
        found.append(f"rows {len(mine)} against {len(theirs)}")
    if mine != theirs:
        ours, sqls = set(mine), set(theirs)
        found.append(f"{len(ours - sqls)} rows only here, e.g. {sorted(ours - sqls, key=repr)[:2]}")
        found.append(f"{len(sqls - ours)} rows only in SQL, e.g. {sorted(sqls - ours, key=repr)[:2]}")
    return found
