"""Registered queries and, for each, the same result in plain SQL."""

from __future__ import annotations

import importlib

_PARTS = ("scans", "filters", "joins", "aggregates", "windows", "streams", "plans", "quality")


def _load():
    for part in _PARTS:
        importlib.import_module(f"fundtide.catalog.{part}")
    return importlib.import_module("fundtide.catalog.base")


def queries():
    return dict(_load().QUERIES)


def oracle_sql():
    return dict(_load().ORACLES)
