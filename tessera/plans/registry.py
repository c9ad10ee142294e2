"""Every registered query of the engine with its SQL equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["backbone_edges"](spark, sf_dir)


from . import graph_queries, mention_queries, more_queries, review_queries, text_queries  # noqa: E402, F401  (they register themselves)
