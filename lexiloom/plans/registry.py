"""Named queries of one module and, where given, their SQL."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict[str, Callable], dict[str, str], Callable]:
    """(queries, SQL by name, decorator that registers a query with its SQL, if any)."""
    queries: dict[str, Callable] = {}
    oracles: dict[str, str] = {}

    def query(sql: str | None = None):
        def add(f):
            queries[f.__name__] = f
            if sql is not None:
                oracles[f.__name__] = sql
            return f

        return add

    return queries, oracles, query
