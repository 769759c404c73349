"""Registered queries and the SQL they are checked against."""

import importlib

_MODULES = ("usage", "retention", "churn", "stream", "checks", "stored")


def load():
    """Import every query module once and return the registry."""
    for name in _MODULES:
        importlib.import_module(f"catalog.{name}")
    return importlib.import_module("catalog.registry")
