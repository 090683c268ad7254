"""Registered queries: every operator on the given tables, with the SQL that gives the same rows.

The SQL is written independently of the operators; both read whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}
_MODULES = ("sources", "checks", "transforms", "splits", "joins", "metrics", "synthetic", "models", "streams", "plans")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows can be checked."""

    def add(run: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")
        ENTRIES[name] = Entry(run, sql)
        return run

    return add


def load_all() -> dict[str, Entry]:
    """Import every module of queries."""
    for module in _MODULES:
        import_module(f"registry.{module}")
    return ENTRIES
