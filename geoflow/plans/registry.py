"""Registered queries: one per operator, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .layers import LAYER_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def with_layers(*names: str, sql: str) -> str:
    """SQL preceded by the named layers as common table expressions."""
    return "with " + ",\n".join(f"{n} as ({LAYER_SQL[n]})" for n in names) + "\n" + sql


def query(key: str, sql: str | None = None, layers: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key!r} is already registered")
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = with_layers(*layers, sql=sql) if layers else sql
        return function

    return register
