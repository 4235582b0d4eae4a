"""Upserting and merging a stream into a table, one micro-batch after the other."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from framestore.errors import InvalidInputError
from framestore.sinks.journal import read_json
from framestore.store import TableStore


def upsert_stream(
    stream: DataFrame,
    store: TableStore,
    table: str,
    keys: str | Sequence[str],
    checkpoint_location: str,
    trigger: dict[str, Any] | None = None,
    use_merge: bool = False,
    **options: Any,
) -> StreamingQuery:
    """Start a query that upserts (or merges) each micro-batch of `stream` into `table`.

    A micro-batch plays the part of a chunk: its rows update the rows that
    earlier batches inserted. The table notes the id of the query, which the checkpoint keeps, and the number of the
    batch in the step that makes its rows visible, so a batch that is run again after a failure is skipped. (Bucketed
    and external tables get the note after the rows. A failure between the two runs the batch again,
    which changes nothing but repeats rows with a NULL key.) `options` go
    to `TableStore.upsert_table` or `TableStore.merge_df`.
    """
    if not stream.isStreaming:
        raise InvalidInputError("upsert_stream needs a streaming DataFrame")

    def write(batch: DataFrame, batch_id: int) -> None:
        # A micro-batch belongs to a session of its own.
        spark = batch.sparkSession
        batch_store = store.with_session(spark)
        apply = batch_store.merge_df if use_merge else batch_store.upsert_table
        query = read_json(spark, f"{checkpoint_location.rstrip('/')}/metadata")["id"]
        apply(batch, table, keys, batch=(query, batch_id), **options)
        # The session of the store remembers where the rows were.
        store.spark.catalog.refreshTable(store.qualified(table))

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_location)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
