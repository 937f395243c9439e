"""Query registry: a Spark plan and, where SQL can say it, its ANSI counterpart."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gondola.plans import oracle_views
from gondola.plans.lake import Lake

_PLANS: dict[str, Callable[[Lake], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``plan(lake)`` under ``name``, with the SQL body it must agree with."""
    def add(plan: Callable[[Lake], DataFrame]):
        if name in _PLANS:
            raise ValueError(f"query {name} is registered twice")
        _PLANS[name] = plan
        if sql:
            _SQL[name] = sql
        return plan
    return add


def plans() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, p=plan: p(Lake(spark, sf_dir)))
            for name, plan in _PLANS.items()}


def sql_texts() -> dict[str, str]:
    return {name: with_views(body) for name, body in _SQL.items()}


def with_views(body: str) -> str:
    """Prefix the WITH definitions a body uses, in dependency order."""
    views = oracle_views.VIEWS
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in views:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(views[name])
    visit(body)
    ctes = ",\n".join(f"{n} AS ({views[n]})" for n in views if n in needed)
    if not ctes:
        return body
    for head in ("WITH RECURSIVE ", "WITH "):  # a body may define more
        if body.lstrip().startswith(head):
            return f"{head}{ctes},\n{body.lstrip()[len(head):]}"
    return f"WITH {ctes}\n{body}"
