"""Names of queries, and the pairing with their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from .projection import VIEWS, Domain

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: bool = True):
    """Registers a function of a Domain; sql says the same in DuckDB, after the projection's views."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Domain(spark, sf_dir))
        if sql:
            ORACLE[name] = VIEWS + sql if views else sql
        return f

    return add
