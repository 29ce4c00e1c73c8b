"""Registered queries with their reference SQL."""

from importlib import import_module

MODULES = ("basics", "domain", "jobs", "models")


def load() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
