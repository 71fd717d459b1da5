"""Registered queries over the supplied tables, each with its SQL counterpart."""

from __future__ import annotations

from importlib import import_module

MODULES = ("reports", "sources", "filters", "actions", "tables", "streams")


def registry():
    """All queries; importing a module registers its own."""
    from spendlake.queries.base import REGISTRY

    for module in MODULES:
        import_module(f"spendlake.queries.{module}")
    return REGISTRY
