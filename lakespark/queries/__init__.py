"""Registered queries: one per operator, each with SQL that must give the same rows."""

from importlib import import_module

FAMILIES = ("science", "aggregates", "spatial", "mapping", "ledger")


def load():
    """(queries, SQL counterparts) of all families."""
    from lakespark.queries import base

    for family in FAMILIES:
        import_module(f"lakespark.queries.{family}")
    return base.QUERIES, base.ORACLES
