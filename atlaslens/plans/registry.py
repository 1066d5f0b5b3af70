"""Names of the queries, with the SQL each one must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from atlaslens.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name; ``sql`` gives the same rows in another engine."""

    def register(build: Query) -> Query:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        QUERIES[name] = prepared
        if sql:
            ORACLES[name] = sql
        return build

    return register
