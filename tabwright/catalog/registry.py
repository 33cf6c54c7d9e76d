"""Collects queries and builds their comparison SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tabwright.sources.dirty_views import VIEWS, Tables, view_sql


@dataclass(frozen=True)
class Entry:
    key: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(key: str, sql: str | None = None):
    """Register a function of ``Tables``. Views named in the SQL are put in front of it."""

    def register(build: Callable[[Tables], DataFrame]):
        if key in ENTRIES:
            raise ValueError(f"query '{key}' registered twice")
        ENTRIES[key] = Entry(key, lambda spark, folder: build(Tables(spark, folder)), with_views(sql) if sql else None)
        return build

    return register


def with_views(sql: str) -> str:
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    if not used:
        return sql.strip()
    head = ",\n".join(f"{v} AS ({view_sql(v)})" for v in used)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def r6(expression: str) -> str:
    """SQL text rounding as ``types.rounded`` does."""
    return f"(round(CAST(({expression}) AS DOUBLE), 6) + CAST(0 AS DOUBLE))"


def dbl(expression: str) -> str:
    return f"CAST(({expression}) AS DOUBLE)"
