"""Registered queries: each binds an operator to the supplied tables and, where SQL can say it, to its SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("comment_queries", "graph_queries", "model_queries", "record_queries", "stream_queries")


def load_all():
    """All registered queries and comparison SQL, by name."""
    from loomstat.plans import registry

    for module in MODULES:
        import_module(f"loomstat.plans.{module}")
    return dict(registry.QUERIES), dict(registry.ORACLES)
