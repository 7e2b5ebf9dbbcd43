"""The query register: name -> DataFrame job, and name -> SQL giving the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
SOURCE: dict[str, str] = {}  # module each query is written in


def query(sql: str | None = None, name: str | None = None):
    """Register ``fn(t: Tables)`` under its name; ``sql`` may mention fixture views."""

    def wrap(fn):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        SOURCE[key] = fn.__module__
        if sql:
            ORACLE[key] = with_views(sql)
        return fn

    return wrap


from . import (  # noqa: E402,F401
    queries_intervals,
    queries_rows,
    queries_transfer,
    queries_genotypes,
    queries_counting,
    queries_matching,
    queries_depth,
)
