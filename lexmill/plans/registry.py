"""Queries by name, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from lexmill.session import find_code

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Collects queries; ``sql`` stays empty where SQL cannot express the result."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        def add(function: Query) -> Query:
            key = name or function.__name__
            if key in self.queries:
                raise ValueError(f"two queries are named {key}")

            @wraps(function)
            def run(spark: SparkSession, directory: str) -> DataFrame:
                find_code(spark)
                return function(spark, directory)

            self.queries[key] = run
            if sql is not None:
                self.sql[key] = sql
            return function

        return add
