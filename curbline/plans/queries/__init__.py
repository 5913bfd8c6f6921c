"""Registered queries: each runs an operator over the test tables.

``all_queries`` and ``all_oracles`` collect what the modules of this package
register; an oracle is the same computation written independently in SQL.
"""

from __future__ import annotations

from curbline.plans.queries import (  # noqa: F401
    calendars,
    cleaning,
    jobs,
    joining,
    keying,
    merging,
    quality,
    registry,
    shaping,
    storage,
    summarising,
)


def all_queries():
    return dict(registry.QUERIES)


def all_oracles():
    return dict(registry.ORACLES)
