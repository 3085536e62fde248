"""Runs registered queries next to their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return db


def _plain(value: object) -> object:
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    return value


def sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark_df: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    result = db.execute(sql)
    names, expected = [d[0] for d in result.description], result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(names)}"
    kinds = {d[0]: str(d[1]) for d in result.description}
    wide = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for name, kind in spark_df.dtypes:
        if wide.get(kind, kind) != kinds[name]:
            return f"column {name} is {kind} instead of {kinds[name]}"
    got = sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    want = sorted_rows(names, expected)
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else None
