"""Collecting the queries of the plan modules."""

from __future__ import annotations


class Registry:
    """Queries by name, each with the same result in SQL where SQL can say it."""

    def __init__(self) -> None:
        self.queries: dict = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None, name: str | None = None):
        def add(function):
            key = name or function.__name__
            self.queries[key] = function
            if sql is not None:
                self.sql[key] = sql
            return function

        return add
