"""Registered queries and their SQL oracles."""

import importlib

MODULES = ("features", "shapes", "scores", "texts", "monitor", "training", "streams")


def load():
    """(queries, oracles) of all modules."""
    from voltide.catalog import registry

    for name in MODULES:
        importlib.import_module(f"voltide.catalog.{name}")
    return dict(registry.QUERIES), dict(registry.ORACLES)
