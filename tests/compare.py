"""Spark result against DuckDB result: names, types, rows and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(data_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _key(row: tuple) -> tuple:
    """Sort key: texts and integers first, then doubles at nine digits."""
    exact = [("" if v is None else str(v)) for v in row if not isinstance(v, float)]
    rough = [f"{v:.9e}" for v in row if isinstance(v, float)]
    return tuple(exact), tuple(rough)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return a == b


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a DataFrame and a statement; empty when nothing."""
    names = sorted(df.columns)
    result = con.sql(sql)
    types = dict(zip(result.columns, (str(t) for t in result.types)))
    if names != sorted(types):
        return [f"columns {names} against {sorted(types)}"]
    found = [
        f"type of {f.name}: {f.dataType.simpleString()} against {types[f.name]}"
        for f in df.schema
        if SPARK_TO_DUCK.get(f.dataType.simpleString()) != types[f.name]
    ]
    quoted = ", ".join(f'"{n}"' for n in names)
    expected = sorted(con.sql(f"SELECT {quoted} FROM ({sql})").fetchall(), key=_key)
    actual = sorted(
        (tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key
    )
    if len(actual) != len(expected):
        return [*found, f"{len(actual)} rows against {len(expected)}"]
    unequal = [
        (a, e)
        for a, e in zip(actual, expected)
        if not all(_same(x, y) for x, y in zip(a, e))
    ]
    inexact = sum(a != e for a, e in zip(actual, expected))
    if unequal:
        found.append(f"{len(unequal)} rows differ, first: {unequal[0]}")
    elif inexact:
        found.append(f"inexact: {inexact} rows equal only within tolerance")
    return found
