"""Every operator as a query over the given tables, with checking SQL beside it."""

from __future__ import annotations

import importlib

MODULES = ["events", "signals", "ledger", "rules", "table", "feeds"]


def _modules():
    return [importlib.import_module(f"tidemark.catalog.{name}") for name in MODULES]


def queries() -> dict:
    return {name: fn for module in _modules() for name, fn in module.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in _modules() for name, sql in module.ORACLES.items()}
