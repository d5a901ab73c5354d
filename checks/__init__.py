"""One query per operator over the given tables, with the SQL that must give the same rows."""

from __future__ import annotations


def load():
    """All queries and all oracle texts, by name."""
    from checks import columns, intake, usage  # noqa: F401
    from checks.registry import ORACLES, QUERIES

    return dict(QUERIES), dict(ORACLES)
