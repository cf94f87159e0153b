"""Named queries over the tables, each with its SQL where SQL can express it."""

import importlib

from lexmill.plans.registry import Registry

MODULES = ("references", "texts", "records", "matches", "aggregates", "loads", "inputs")


def registries() -> list[Registry]:
    """The registry of every module of queries, in a fixed order."""
    return [importlib.import_module(f"lexmill.plans.{name}").registry for name in MODULES]
