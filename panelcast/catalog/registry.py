"""Named queries over the test tables, each with the SQL that must give the same rows."""

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


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Record a query under ``name``; without ``sql`` it is checked by its unit tests only."""

    def keep(run: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"duplicate query {name!r}")
        ENTRIES[name] = Entry(run, sql)
        return run

    return keep
