"""Upsert: update the rows of a target that match a source on key columns, insert the rest.

The result equals running, for each chunk of source rows, one UPDATE per row and
then one INSERT ... WHERE NOT EXISTS per row:

* a NULL in a key matches nothing: the row updates nothing and is inserted;
* every target row with a matching key is updated, by the last source row;
* of several source rows with the same new key, the first is inserted; when they
  lie in different chunks, the later chunks update it, so the last one counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from framestore.errors import InvalidColumnNameError, InvalidInputError
from framestore.functions.nulls import nan_to_null
from framestore.functions.project import pick
from framestore.operators.changes import Changes
from framestore.operators.chunks import POSITION, with_positions
from framestore.operators.keyed import align_types, collapse, unmatched
from framestore.session import fits_broadcast
from framestore.validation import ColumnPlan, as_list, check_choice, check_chunksize, check_columns, plan_columns

DUPLICATE_MODES = ("error", "sequential", "unique")
_CHUNK = "__chunk"


def prepare_source(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    chosen: str | Sequence[str] | None,
    index_cols: str | Sequence[str] | None,
    chosen_index: bool | str | Sequence[str],
    order_by: str | Sequence[str] | None,
    nan_as_null: bool,
    target_columns: Sequence[str],
) -> tuple[DataFrame, ColumnPlan, list[str]]:
    """Resolve the columns, then cut and cast the source to what the target needs."""
    columns = plan_columns(source.columns, keys, chosen, index_cols, chosen_index)
    check_columns(columns.needed, target_columns, "target")
    order = check_columns(as_list(order_by), source.columns)
    if any(c in target.columns and target.schema[c].dataType != source.schema[c].dataType for c in order):
        # Sort by the source values, not by their form after the cast to the target type.
        source = source.select("*", *[F.col(f"`{c}`").alias(f"__order_{c}") for c in order])
        order = [f"__order_{c}" for c in order]
    rows = pick(source, list(dict.fromkeys([*columns.needed, *order])))
    if nan_as_null:
        rows = nan_to_null(rows)
    return align_types(rows, target.schema), columns, order


def duplicate_mode(on_duplicate: str | None, order: Sequence[str]) -> str:
    if on_duplicate is None:
        return "sequential" if order else "error"
    return check_choice("on_duplicate", on_duplicate, DUPLICATE_MODES)


def upsert_changes(
    target: DataFrame,
    source: DataFrame,
    where_cols: str | Sequence[str],
    upsert_cols: str | Sequence[str] | None = "all",
    *,
    index_cols: str | Sequence[str] | None = None,
    upsert_index_cols: bool | str | Sequence[str] = False,
    update_only: bool = False,
    insert_only: bool = False,
    chunksize: int | None = None,
    nan_as_null: bool = True,
    order_by: str | Sequence[str] | None = None,
    on_duplicate: str | None = None,
    co_located: bool = False,
) -> Changes:
    """What an upsert of `source` into `target` changes. Nothing is written.

    `order_by` names the source columns that give the row order; it is needed
    when keys may repeat in the source. `on_duplicate` is then 'sequential' (the
    default with `order_by`); without an order a repeated key fails the query
    ('error'), and 'unique' trusts the source and saves the check. With
    `chunksize` and 'sequential' the rows are numbered first, which runs a job.
    `co_located` says that the target is bucketed by the keys.
    """
    check_chunksize(chunksize)
    if update_only and insert_only:
        raise InvalidInputError("update_only and insert_only exclude each other")
    rows, columns, order = prepare_source(
        target, source, where_cols, upsert_cols, index_cols, upsert_index_cols, order_by, nan_as_null, target.columns
    )
    mode = duplicate_mode(on_duplicate, order)
    if mode == "sequential" and not order:
        raise InvalidInputError("order_by is needed for on_duplicate='sequential'")
    if not columns.update and not insert_only:
        raise InvalidInputError(
            "No columns to update: all chosen columns are keys. Use insert_only=True to insert only new keys",
            data=list(columns.keys),
        )
    keys_inserted = set(columns.keys) <= set(columns.insert)
    if not keys_inserted and not columns.insert:
        raise InvalidColumnNameError("No columns to insert", data=list(columns.keys))

    picks: dict[str, tuple[str, Sequence[str]]] = {}
    extra: list[Column] = []
    scratch: tuple[str, ...] = ()
    if not insert_only:
        picks["__update"] = ("last", columns.update)
    if not update_only and keys_inserted:
        picks["__insert"] = ("first", columns.insert)
        if chunksize is not None and mode == "sequential":
            positioned = with_positions(rows, order)
            scratch = (positioned.path,)
            rows = positioned.df.withColumn(_CHUNK, F.floor(F.col(POSITION) / F.lit(chunksize))).drop(POSITION)
            picks["__insert_last"] = ("last", columns.insert)
            extra = [(F.min(_CHUNK) == F.max(_CHUNK)).alias("__one_chunk")]
    keyed = collapse(rows, columns.keys, picks, order, mode, extra)
    if extra:
        chosen = F.when(F.col("__one_chunk"), F.col("__insert")).otherwise(F.col("__insert_last"))
        keyed = keyed.withColumn("__insert", chosen).drop("__insert_last", "__one_chunk")

    small = fits_broadcast(rows)
    inserts = null_inserts = new_keys = None
    if not update_only:
        if keys_inserted:
            new = unmatched(pick(keyed, columns.keys, "__insert"), target, columns.keys, small, unique_rows=True)
            inserts = new.select("__insert.*")
            new_keys = None if small else pick(keyed, columns.keys)
        else:
            # The inserted rows do not carry their keys, so later duplicates never find them.
            inserts = pick(unmatched(rows, target, columns.keys, small, unique_rows=False), columns.insert)
        null_inserts = rows
    return Changes(
        target=target,
        keyed=None if insert_only else pick(keyed, columns.keys, "__update"),
        keys=columns.keys,
        update=columns.update,
        insert=columns.insert,
        new_row="__update",
        inserts=inserts,
        null_key_rows=null_inserts,
        new_keys=new_keys,
        co_located=co_located,
        scratch=scratch,
    )


def upsert(target: DataFrame, source: DataFrame, where_cols: str | Sequence[str], *args, **kwargs) -> DataFrame:
    """The target after the upsert. Parameters as for `upsert_changes`."""
    return upsert_changes(target, source, where_cols, *args, **kwargs).result()


def update(target: DataFrame, source: DataFrame, where_cols: str | Sequence[str], *args, **kwargs) -> DataFrame:
    """The target with matching rows updated and nothing inserted."""
    return upsert_changes(target, source, where_cols, *args, update_only=True, **kwargs).result()
