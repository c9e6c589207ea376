"""End-to-end plans and the catalogue of named queries."""

from __future__ import annotations

from importlib import import_module

from .registry import ORACLES, QUERIES

_CATALOGUE = ["catalog_quality", "catalog_cluster", "catalog_assembly", "catalog_taxonomy", "catalog_report"]


def _load() -> None:
    for name in _CATALOGUE:
        import_module(f"{__name__}.{name}")


def all_queries() -> dict:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict:
    _load()
    return dict(ORACLES)
