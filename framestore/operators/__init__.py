"""Table operators as functions from DataFrames to DataFrames."""

from framestore.operators.changes import Changes
from framestore.operators.chunks import chunk_ids, iter_chunks, with_positions
from framestore.operators.merge import merge, merge_changes
from framestore.operators.upsert import update, upsert, upsert_changes

__all__ = [
    "Changes",
    "chunk_ids",
    "iter_chunks",
    "merge",
    "merge_changes",
    "update",
    "upsert",
    "upsert_changes",
    "with_positions",
]
