"""Runnable plans: one per operator, on the given tables, most with an SQL counterpart."""

from tidemark.plans.registry import PLANS, Inputs

# Importing a module registers its plans.
from tidemark.plans import (  # noqa: F401  isort: skip
    aggregates, expressions, joins, keyed, queries, scans, streams, writes,
)

__all__ = ["PLANS", "Inputs"]
