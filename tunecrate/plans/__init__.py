"""Named queries over the warehouse tables and their SQL twins."""

from importlib import import_module

MODULES = ["recall_queries", "report_queries", "vector_queries", "model_queries", "source_queries", "store_queries"]


def load_all() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
