"""End-to-end queries over the test tables, grouped by subject."""

from importlib import import_module

MODULES = ("sales_queries", "series_queries", "customer_queries", "model_queries")


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"tidemark.plans.{name}")
