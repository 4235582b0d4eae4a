"""Operators of a training-data pipeline. Nothing else in the package imports them."""

from framestore.llm import codes, exact_dedup, jaccard, lines, packing, pieces, quality, repeats, secrets, sharding, spelling, tiers, warc  # noqa: F401
from framestore.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
