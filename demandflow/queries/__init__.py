"""The registered queries and, where SQL can say the same, their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under the name of its function."""
    QUERIES[fn.__name__] = fn
    return fn


def load_all() -> dict[str, Query]:
    from demandflow.queries import accuracy, files, forecasts, models, quality, series, tiers  # noqa: F401

    return dict(QUERIES)
