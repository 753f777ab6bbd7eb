"""Registered queries over the supplied tables, each with its SQL twin."""

from __future__ import annotations

from importlib import import_module

_SECTIONS = ("datasets", "features", "rules", "evaluation", "graphs", "discovery")


def _load() -> None:
    for section in _SECTIONS:
        import_module(f"tidegate.catalog.{section}")


def queries() -> dict:
    from tidegate.catalog.registry import QUERIES
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from tidegate.catalog.registry import SQL
    _load()
    return dict(SQL)
