"""Compare a query's result with its SQL on the same Parquet files."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(rows: list[tuple], names: list[str]) -> list[tuple]:
    """Rows with columns in name order, sorted by their text form."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def expected(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted(names), normal(cursor.fetchall(), names)


def actual(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), normal([tuple(r) for r in df.collect()], df.columns)
