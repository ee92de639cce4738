"""Queries over the driver's tables, each beside the SQL it is checked against."""

from __future__ import annotations

import importlib

#: Modules with a QUERIES table {name: (function of session and folder, SQL or None)}.
MODULES = [f"tidelane.catalog.{m}" for m in ("recordings", "quality", "alignment", "features", "evaluation", "runtime", "streams")]


def registered(modules: list[str] | None = None) -> dict:
    """All queries of the modules (default: the catalog's own)."""
    found: dict = {}
    for name in modules or MODULES:
        found |= importlib.import_module(name).QUERIES
    return found
