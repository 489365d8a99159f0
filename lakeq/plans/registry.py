"""Queries by the name of their function, with their SQL."""

from __future__ import annotations

from collections.abc import Callable


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None):
        """Registers a query under its function's name, with its SQL."""

        def add(f):
            self.queries[f.__name__] = f
            if sql is not None:
                self.sql[f.__name__] = sql
            return f

        return add
