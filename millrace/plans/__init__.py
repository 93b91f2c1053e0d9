"""Registered queries over the test tables, each next to its check SQL."""

from importlib import import_module

MODULES = (
    "elementwise",
    "aggregation",
    "joining",
    "nesting",
    "sqlapi",
    "reading",
    "writing",
    "windowing",
    "firing",
    "streams",
    "deliveries",
    "logfilter",
    "jobs",
)


def load_all() -> None:
    for name in MODULES:
        import_module(f"millrace.plans.{name}")
