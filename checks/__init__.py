"""Queries over the given tables, each beside the SQL that gives the same answer."""

from importlib import import_module

MODULES = ("star", "metrics", "text", "nested", "quality", "landing", "portfolio", "dated")


def load():
    """Import every query module and return the registry."""
    for name in MODULES:
        import_module(f"checks.{name}")
    return import_module("checks.registry")
