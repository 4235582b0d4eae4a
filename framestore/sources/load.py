"""What happens to rows after they are read: parse, cast, convert, key columns."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame

from framestore.errors import SetIndexError
from framestore.functions.datetimes import DEFAULT_FORMAT, convert_datetime_columns
from framestore.functions.parsing import cast_columns, coerce_decimals, parse_dates as parse_date_columns
from framestore.operators.keyed import quoted

logger = logging.getLogger(__name__)


def keys_first(df: DataFrame, index_col: str | Sequence[str] | None) -> DataFrame:
    """Move the key columns to the front. Spark has no row labels beside the columns."""
    if index_col is None:
        return df
    names = [index_col] if isinstance(index_col, str) else index_col
    if not isinstance(names, (list, tuple)) or not all(isinstance(n, str) for n in names):
        raise SetIndexError(f"index_col must be a name or a sequence of names, got {index_col!r}", data=index_col)
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise SetIndexError(f"Cannot use {missing} as key columns, columns: {df.columns}", data=index_col)
    names = list(dict.fromkeys(names))
    return df.select(*[quoted(n) for n in names], *[quoted(c) for c in df.columns if c not in names])


def shape_rows(
    df: DataFrame,
    index_col: str | Sequence[str] | None = None,
    parse_dates: Any = None,
    datetime_cols_dtype: str | None = None,
    datetime_format: str = DEFAULT_FORMAT,
    localize_tz: str | None = None,
    target_tz: str | None = None,
    dtypes: dict[str, Any] | None = None,
    coerce_float: bool = True,
    dst: str = "raise",
    validate: bool = False,
    warn_if_empty: bool = False,
    local_epoch: bool = False,
) -> DataFrame:
    """Apply the load options to rows that were read, in their fixed order.

    Decimals to double and parsed dates, then casts, then the datetime
    conversion, then the key columns. All of it is one lazy projection.
    """
    if coerce_float:
        df = coerce_decimals(df)
    df = parse_date_columns(df, parse_dates)
    if warn_if_empty and df.isEmpty():
        logger.warning("The result is empty.")
    df = cast_columns(df, dtypes, validate)
    df = convert_datetime_columns(df, datetime_cols_dtype, datetime_format, localize_tz, target_tz, dst, local_epoch)
    return keys_first(df, index_col)
