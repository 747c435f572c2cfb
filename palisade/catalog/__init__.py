"""Named queries over the given tables, each with its SQL where SQL can say it."""

from importlib import import_module

from palisade.catalog.registry import QUERIES, Query

_GROUPS = [
    "text_queries",
    "gate_queries",
    "evaluation_queries",
    "run_queries",
    "retrieval_queries",
    "source_queries",
    "stream_queries",
]


def all_queries() -> dict[str, Query]:
    for group in _GROUPS:
        import_module(f"palisade.catalog.{group}")
    return QUERIES
