"""The registered queries: each a function of (session, table folder) with, where SQL can
say the same, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def load_all() -> tuple[dict[str, Query], dict[str, str]]:
    from riskloom.plans import queries_jobs, queries_models, queries_sources, queries_streams, queries_tables  # noqa: F401

    return dict(QUERIES), dict(ORACLES)
