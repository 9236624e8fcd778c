"""Registry of the named queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def load_all() -> None:
    from tidewatch.plans import (  # noqa: F401
        behavior_queries, flow_queries, health_queries, ingest_queries, model_queries, rule_queries, scalar_queries,
        session_queries, stream_queries,
    )
