"""Checkable queries, one per operator."""

from importlib import import_module

MODULES = ["scans", "columns", "ingesting", "enriching", "labelling", "placing", "quality", "publishing"]


def all_queries():
    """Registered queries and their SQL twins."""
    for name in MODULES:
        import_module(f"postsieve.catalog.{name}")
    from postsieve.catalog.base import ORACLES, QUERIES

    return dict(QUERIES), dict(ORACLES)
