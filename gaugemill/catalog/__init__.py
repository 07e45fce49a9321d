"""Registered queries over the benchmark tables and their equivalent SQL."""

from __future__ import annotations

from gaugemill.catalog import models, rows, statistics


def _modules():
    return rows, statistics, models


def all_queries() -> dict:
    return {name: fn for m in _modules() for name, fn in m.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in m.ORACLE.items()}
