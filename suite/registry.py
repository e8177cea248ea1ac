"""Name -> query function and checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``function(spark, folder)``; ``sql`` is run on the same tables to check it."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def filled(text: str, /, **values: str) -> str:
    """SQL that fills the braces of a template with SQL expressions."""
    out = text_literal(text)
    for name, expression in values.items():
        out = f"replace({out}, '{{{name}}}', {expression})"
    return out
