"""The table of named queries."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Query(NamedTuple):
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL it must agree with."""

    def add(build):
        QUERIES[build.__name__] = Query(build, sql)
        return build

    return add
