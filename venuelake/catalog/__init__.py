"""All named queries with the SQL that checks them."""

from __future__ import annotations

import importlib

from .registry import ORACLES, QUERIES

_MODULES = ("expressions", "relational", "classifiers", "ingest", "sales", "finance", "guests", "comps", "streams")


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"{__name__}.{name}")


def all_queries():
    _load()
    return QUERIES


def all_oracles():
    _load()
    return ORACLES
