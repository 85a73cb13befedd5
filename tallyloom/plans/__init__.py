"""Named queries over the given tables."""

import importlib

from tallyloom.plans import registry

MODULES = ("relational", "storage", "profiling", "text", "basket", "features", "linear", "models", "clustering", "flows", "facts")


def load_all():
    for name in MODULES:
        importlib.import_module(f"tallyloom.plans.{name}")
    return registry
