"""Composite plans (C1-C7) and the registry of named queries."""

import importlib

_MODULES = ["exploration", "features", "evaluation", "ingest", "streams", "models", "rowops"]


def load_all() -> None:
    """Import every plan module so that its queries register themselves."""
    for m in _MODULES:
        importlib.import_module(f"{__name__}.{m}")
