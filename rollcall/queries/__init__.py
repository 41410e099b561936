"""Named queries over the benchmark tables, one per operator."""

from rollcall.queries.registry import QUERIES, REFERENCE_SQL

__all__ = ["QUERIES", "REFERENCE_SQL", "load_all"]


def load_all() -> None:
    """Import every module that registers queries."""
    from rollcall.queries import (  # noqa: F401
        aggregates, modelling, plan_outputs, quality, relational, scalars, statistics, storage, streams, windows,
    )
