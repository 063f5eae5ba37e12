"""Every operator as a query over the given tables."""

from __future__ import annotations

import importlib

MODULES = ("text", "filters", "joins", "trees", "statistics", "extracts", "reports", "changes", "files", "stored")


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"vitrine.catalog.{name}")


def all_queries():
    from vitrine.catalog.registry import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles():
    from vitrine.catalog.registry import ORACLES

    _load()
    return dict(ORACLES)
