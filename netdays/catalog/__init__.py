"""Registered queries over the driver's tables, each with its SQL check."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from netdays.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that must agree."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def load() -> None:
    """Import the modules that register queries."""
    from netdays.catalog import (  # noqa: F401
        incremental,
        ledgers,
        lookups,
        parties,
        payable,
        quality,
        receivable,
        reports,
        runs,
        varied,
    )
