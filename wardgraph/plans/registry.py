"""Every query of the engine by name, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardgraph.plans.bridge import Bridge, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a function of the bridge views under its name, and SQL over the same views."""

    def add(f: Callable[[Bridge], DataFrame]):
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"two queries are named {key}")
        QUERIES[key] = lambda spark, sf_dir: f(Bridge(spark, sf_dir))
        if sql:
            ORACLES[key] = with_views(sql)
        return f

    return add


from wardgraph.plans import chain_queries, graph_queries, layer_queries, source_queries, stream_queries, telemetry_queries  # noqa: E402, F401
