"""A query and its SQL, registered side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self._queries: dict[str, Query] = {}
        self._sql: dict[str, str] = {}

    def add(self, sql: str | None) -> Callable[[Query], Query]:
        """Register the function under its own name; without SQL only its rows are checked."""

        def keep(run: Query) -> Query:
            self._queries[run.__name__] = run
            if sql is not None:
                self._sql[run.__name__] = sql
            return run

        return keep

    def queries(self) -> dict[str, Query]:
        return dict(self._queries)

    def oracle_sql(self) -> dict[str, str]:
        return dict(self._sql)
