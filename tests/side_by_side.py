"""Run a registered query and its SQL on the same tables and compare them."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (2, "nan" if math.isnan(value) else f"{value:.9g}")
    return (3, f"{type(value).__name__}:{value}")


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(_plain(row[i]) for i in order) for row in rows
    )


def differences(con, spark_df, sql: str) -> str | None:
    """None where both sides agree, else what differs first."""
    cursor = con.execute(sql)
    theirs = _sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    ours = _sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} != {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            return f"{a}\n != {b}"
    return None
