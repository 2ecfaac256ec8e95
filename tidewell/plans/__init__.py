"""Registered plans, one module per family."""

from importlib import import_module

FAMILIES = (
    "scans",
    "relational",
    "aggregates",
    "strings",
    "series",
    "retrieval",
    "evaluation",
    "features",
    "models",
    "maintenance",
    "streams",
)


def load_all() -> None:
    for name in FAMILIES:
        import_module(f"{__name__}.{name}")
