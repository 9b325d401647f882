"""Compare a query with its SQL on the same tables, row by row."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb

DATA = Path(os.environ.get("CDCLAKE_TEST_DATA", "/root/testdata/sf0.001"))


def expected(sql: str, data: Path = DATA) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for file in sorted(data.glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = con.execute(sql)
    return _sorted([d[0] for d in result.description], result.fetchall())


def actual(df) -> tuple[list[str], list[tuple]]:
    return _sorted(df.columns, [tuple(r) for r in df.collect()])


def _sorted(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)
