"""navnet: a PySpark-native engine for waterway networks and corpus preparation."""

from importlib import import_module

#: The library's main entries and their modules, loaded when asked for: tasks import this package too.
_ENTRIES = {
    "assign": "operators.traffic", "build_dropins": "operators.dropins", "build_graph": "operators.graph", "components": "operators.components", "enriched": "operators.network", "foreign_graph": "operators.network",
    "harbours": "operators.network", "merge_graphs": "operators.graph", "route": "operators.graph", "splice": "operators.splice", "stitched": "operators.network", "timer": "timing",
}

__all__ = sorted(_ENTRIES)


def __getattr__(name: str):
    if name not in _ENTRIES:
        raise AttributeError(f"module 'navnet' has no attribute {name!r}")
    module = import_module(f".{_ENTRIES[name]}", __name__)
    return getattr(module, {"build_dropins": "build"}.get(name, name))
