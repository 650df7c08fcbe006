"""Registers a Spark query together with the SQL that must give the same rows."""

from __future__ import annotations

import importlib
import importlib.util
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitwall.bindings import Tables
from suite.sql_tables import SQL_TABLES

_SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

_MODULES = (
    "suite.scans", "suite.tables", "suite.cleaning", "suite.filters", "suite.joining", "suite.aggregates",
    "suite.windows", "suite.sorting", "suite.scalars", "suite.products", "suite.quality", "suite.streams",
)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``, with its SQL over the racing tables."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in _SPARK:
            raise ValueError(f"{name} is registered twice")
        _SPARK[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            _SQL[name] = with_tables(sql)
        return fn

    return wrap


def with_tables(body: str) -> str:
    """Prefix a query with the table definitions it uses, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for table, definition in SQL_TABLES.items():
            if table not in needed and re.search(rf"(?:FROM|JOIN|,)\s+{table}\b", text):
                visit(definition)
                needed.append(table)

    visit(body)
    if not needed:
        return body.strip()
    ctes = ",\n".join(f"{t} AS ({SQL_TABLES[t].strip()})" for t in needed)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def load() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    for module in _MODULES:
        if importlib.util.find_spec(module) is None:
            continue
        importlib.import_module(module)
    return dict(_SPARK), dict(_SQL)
