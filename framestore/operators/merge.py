"""Merge: source rows update matching target rows or are inserted, one row after the other.

Unlike an upsert, each source row runs its own MERGE, so of several rows with the
same new key the last one counts whatever the chunk size. With
``omit_update_where_clause=False`` a matched row is only updated when a value
differs in the sense of SQL ``<>``: a NULL on either side is no difference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from framestore.errors import InvalidColumnNameError, InvalidInputError
from framestore.functions.project import ident, pick
from framestore.operators.changes import Changes
from framestore.operators.fold import fold_changes, folded_row
from framestore.operators.keyed import collapse, unmatched
from framestore.operators.upsert import duplicate_mode, prepare_source
from framestore.session import fits_broadcast, own_scratch, stage
from framestore.validation import check_chunksize


def last_if_changed(columns: Sequence[str]) -> str:
    """The struct ``__last`` if one of its values differs from the current one, else the current values."""
    changed = " OR ".join(f"{ident(c)} <> __last.{ident(c)}" for c in columns)
    return f"CASE WHEN {changed} THEN __last ELSE struct({', '.join(ident(c) for c in columns)}) END"


def merge_changes(
    target: DataFrame,
    source: DataFrame,
    on_cols: str | Sequence[str],
    merge_cols: str | Sequence[str] | None = "all",
    *,
    index_cols: str | Sequence[str] | None = None,
    merge_index_cols: bool | str | Sequence[str] = False,
    omit_update_where_clause: bool = True,
    null_safe_change: bool = False,
    delete_unmatched: bool = False,
    chunksize: int | None = None,
    nan_as_null: bool = True,
    order_by: str | Sequence[str] | None = None,
    on_duplicate: str | None = None,
    co_located: bool = False,
) -> Changes:
    """What a merge of `source` into `target` changes. Nothing is written.

    `null_safe_change` counts a change from or to NULL as a difference.
    `delete_unmatched` removes target rows that no source row matches.
    `chunksize` does not change the result. A change-only merge of keys that may repeat runs a job that stages
    the summaries of the keys. See `upsert_changes` for the rest.
    """
    check_chunksize(chunksize)
    rows, columns, order = prepare_source(
        target, source, on_cols, merge_cols, index_cols, merge_index_cols, order_by, nan_as_null, target.columns
    )
    mode = duplicate_mode(on_duplicate, order)
    if mode == "sequential" and not order:
        raise InvalidInputError("order_by is needed for on_duplicate='sequential'")
    missing = [k for k in columns.keys if k not in columns.insert]
    if missing:
        raise InvalidColumnNameError(f"Key columns {missing} must be among the columns to merge", data=missing)
    if not columns.update:
        raise InvalidInputError("No columns to update: all chosen columns are keys", data=list(columns.keys))

    scratch: tuple[str, ...] = ()
    only_changed = not omit_update_where_clause and not null_safe_change
    if only_changed and mode == "sequential":
        # The update and the insert branch both read the summaries: they are computed once.
        keyed, path = stage(fold_changes(rows, columns.keys, columns.update, order), "folded")
        own_scratch(rows.sparkSession, path)
        end, scratch = "__inserted", (path,)
        new_row = folded_row(columns.update)
    else:
        # A null safe test leaves the row equal to the source either way: the last row counts.
        keyed, end = collapse(rows, columns.keys, {"__last": ("last", columns.update)}, order, mode), "__last"
        new_row = last_if_changed(columns.update) if only_changed else "__last"

    small = fits_broadcast(rows)
    new = unmatched(keyed, target, columns.keys, small, unique_rows=True)
    return Changes(
        target=target,
        keyed=keyed,
        keys=columns.keys,
        update=columns.update,
        insert=columns.insert,
        new_row=new_row,
        inserts=new.selectExpr(*[ident(c) if c in columns.keys else f"{end}.{ident(c)}" for c in columns.insert]),
        null_key_rows=rows,
        new_keys=None if small else pick(keyed, columns.keys),
        delete_unmatched=delete_unmatched,
        co_located=co_located,
        scratch=scratch,
    )


def merge(target: DataFrame, source: DataFrame, on_cols: str | Sequence[str], *args, **kwargs) -> DataFrame:
    """The target after the merge. Parameters as for `merge_changes`."""
    return merge_changes(target, source, on_cols, *args, **kwargs).result()
