"""Arrow batches of texts, cut to a bounded number of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

BATCH_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of `batch` with about `limit` bytes in `column`, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // limit
    starts = np.flatnonzero(np.diff(part, prepend=-1)) if len(part) else []
    for a, b in zip(starts, [*starts[1:], len(sizes)]):
        yield batch.slice(int(a), int(b - a))


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns `row` (a number of its own per row), `id` and `text` (null: empty)."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )


def id_type(docs: DataFrame, id_col: str) -> str:
    return docs.schema[id_col].dataType.simpleString()
