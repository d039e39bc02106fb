"""The queries of this package and their checking SQL."""

from __future__ import annotations

import importlib

MODULES = [
    "sharding",
    "token_counts",
    "matroska",
    "warc",
    "packing",
    "decontamination",
    "language_id",
    "near_duplicates",
    "suffix_array",
    "language_model",
    "merkle",
    "repair",
    "license_scan",
]


def _modules():
    return [importlib.import_module(f"tidemark.llm.{name}") for name in MODULES]


def queries() -> dict:
    return {name: fn for module in _modules() for name, fn in module.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in _modules() for name, sql in module.ORACLES.items()}
