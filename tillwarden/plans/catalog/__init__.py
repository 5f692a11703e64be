"""Registered queries: every operator over the given tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillwarden.plans.sql import with_views


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def register(name: str, run, needs: list[str] | None = None, sql: str | None = None) -> None:
    if name in CATALOG:
        raise ValueError(f"query {name} is registered twice")
    CATALOG[name] = Query(name, run, with_views(needs or [], sql) if sql else None)


def query(name: str, needs: list[str] | None = None, sql: str | None = None):
    """Register the decorated function under a name, with its SQL twin."""

    def wrap(fn):
        register(name, fn, needs, sql)
        return fn

    return wrap


def load() -> dict[str, Query]:
    from tillwarden.plans.catalog import (  # noqa: F401
        audits,
        files,
        lines,
        lookups,
        sequences,
        streams,
        totals,
    )

    return CATALOG
