"""Collects the named queries and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; ``sql`` is the DuckDB equivalent, if there is one."""

    def add(run: Query) -> Query:
        key = name or run.__name__
        if key in ENTRIES:
            raise ValueError(f"query {key} registered twice")
        ENTRIES[key] = Entry(run, sql)
        return run

    return add
