"""Registered queries over the given tables, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its check."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def load_all() -> None:
    from tradeloom.catalogue import (  # noqa: F401
        ads,
        audit,
        files,
        keyed,
        normalize,
        operations,
        orders,
        placement,
        products,
        publish,
        scalars,
        stocks,
        streams,
    )
