"""Bindings of the operators to the star-schema tables, each with the SQL that checks it where SQL can express it."""

from __future__ import annotations

from importlib import import_module

from . import registry

MODULES = ("scalars", "joins", "aggregates", "sequences", "graphs", "geometry", "tables")


def queries():
    for m in MODULES:
        import_module(f"{__name__}.{m}")
    return registry.queries()


def oracle_sql():
    queries()
    return registry.oracle_sql()
