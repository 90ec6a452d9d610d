"""Registered queries of the engine's own operators, with their SQL oracles."""

from __future__ import annotations

from importlib import import_module

MODULES = ("stats", "indicators", "recursive", "filters", "options", "joins", "aggregates", "reshape", "evidence", "performance", "econometrics", "alpha", "scalars", "languages", "streams", "pricing", "catalog")


def collect() -> tuple[dict, dict]:
    """(queries, SQL) of all modules."""
    queries, sql = {}, {}
    for name in MODULES:
        module = import_module(f"{__name__}.{name}")
        queries |= module.QUERIES
        sql |= module.SQL
    return queries, sql
