"""Named queries for the correctness check, with their SQL."""

from framestore.plans import changing, checking, loading, saving  # noqa: F401
from framestore.plans.registry import ORACLES, QUERIES, Tables

__all__ = ["ORACLES", "QUERIES", "Tables"]
