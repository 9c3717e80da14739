"""The query catalogue: each query with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracewell.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without `sql` it is checked by the tests alone."""

    def add(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(configure(spark), folder)

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def load_all() -> None:
    from tracewell.plans import (  # noqa: F401
        q_commerce,
        q_delivery,
        q_events,
        q_filters,
        q_flows,
        q_redaction,
        q_sessions,
        q_shapes,
        q_sources,
        q_spool,
        q_streaming,
        q_validation,
    )
