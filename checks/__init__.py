"""Queries over the test tables, each with its SQL counterpart where one exists."""

from importlib import import_module

MODULES = (
    "assembly", "selection", "scalars", "social", "pages", "payloads_json", "payloads_html", "streams",
    "jobs",
)


def load() -> None:
    """Import all query modules, which registers their queries."""
    for name in MODULES:
        import_module(f"checks.{name}")
