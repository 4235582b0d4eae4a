"""Bind parameters, IN lists of any length, and sort orders given as text."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from framestore.errors import InvalidInputError
from framestore.functions.project import ident
from framestore.operators.keyed import quoted
from framestore.validation import check_columns


@dataclass(frozen=True)
class Placeholder:
    """A ``:name`` in a SQL statement and what replaces it.

    One value or a sequence of values. With `return_new_placeholders` the values
    become bind parameters; without it they are spliced into the text as they
    are, which is not safe for values from outside.
    """

    placeholder: str
    replacements: Any
    return_new_placeholders: bool = True


def check_value(value: Any) -> Any:
    """Return a value that can be bound: str, int, float, bool or None."""
    if value is None or isinstance(value, (str, int, float, bool)):
        return value
    raise InvalidInputError(f"Values must be str, int, float, bool or None, got {value!r} ({type(value)})", data=value)


def _outside_quotes(stmt: str) -> list[tuple[str, bool]]:
    """Pieces of `stmt` with True for those outside quoted text and identifiers."""
    parts = re.split(r"('(?:[^']|'')*'|\"[^\"]*\"|`[^`]*`)", stmt)
    return [(part, i % 2 == 0) for i, part in enumerate(parts)]


def replace_placeholders(
    stmt: str, placeholders: Placeholder | Sequence[Placeholder], prefix: str = "v"
) -> tuple[str, dict[str, Any]]:
    """Replace placeholders of `stmt`; returns the statement and the bind parameters.

    New parameters are named `prefix` and a number that runs over all
    placeholders. Only whole names outside quotes are replaced. An empty sequence
    gives a list with NULL, which no value equals.
    """
    params: dict[str, Any] = {}
    for p in [placeholders] if isinstance(placeholders, Placeholder) else placeholders:
        values = p.replacements
        if values is None or isinstance(values, (str, int, float, bool)):
            values = [values]
        elif isinstance(values, dict) or not isinstance(values, Iterable):
            raise InvalidInputError(f"Invalid replacements {values!r} ({type(values)})", data=values)
        values = [check_value(v) for v in values]
        if not p.return_new_placeholders:
            text = ", ".join(str(v) for v in values)
        elif not values:
            text = "NULL"
        else:
            names = [f"{prefix}{len(params) + i}" for i in range(len(values))]
            params.update(zip(names, values))
            text = ", ".join(f":{n}" for n in names)
        token = re.compile(r"(?<![:\w])" + re.escape(":" + p.placeholder.lstrip(":")) + r"(?!\w)")
        stmt = "".join(
            token.sub(lambda _: text, part) if outside else part for part, outside in _outside_quotes(stmt)
        )
    return stmt, params


def filter_in(df: DataFrame, column: str, values: Iterable[Any] | DataFrame, negate: bool = False) -> DataFrame:
    """Rows whose `column` is (not) among `values`, a list or a one-column DataFrame.

    A list becomes literals, which are pushed down to the scan, however long it is. A
    DataFrame becomes a semi or anti join; Spark broadcasts it if it is small. Values are
    compared in the type that SQL IN would use for both. As with SQL IN and NOT IN over values without NULL, a NULL in `column` is in
    neither result.
    """
    check_columns([column], df.columns)
    col = quoted(column)
    if isinstance(values, DataFrame):
        if len(values.columns) != 1:
            raise InvalidInputError("values must have one column", data=values.columns)
        wanted = values.toDF("__wanted").where(F.col("__wanted").isNotNull()).distinct()
        # No NULL is left to spread, so this is a plain join, which adaptive execution splits when a value is hot.
        how = "left_anti" if negate else "left_semi"
        return df.where(col.isNotNull()).join(wanted, col == F.col("__wanted"), how).select(*[quoted(c) for c in df.columns])
    items = list(dict.fromkeys(check_value(v) for v in values if v is not None))
    if not items:
        return df.where(col.isNotNull() if negate else F.lit(False))
    among = _in_list(column, items)
    return df.where(~among if negate else among)


def _in_list(column: str, items: list) -> Column:
    """`column IN (...)` as one text: a column object per value would take longer than the query."""
    if any(isinstance(v, str) and set(v) & set("'\\") for v in items) or any(isinstance(v, float) and not math.isfinite(v) for v in items):
        return quoted(column).isin(items)
    kinds = {str: lambda v: f"'{v}'", bool: lambda v: str(v).upper(), int: str, float: lambda v: f"{v!r}D"}
    return F.expr(f"{ident(column)} IN ({', '.join(kinds[type(v)](v) if type(v) in kinds else str(v) for v in items)})")


def sort_columns(spec: str | Sequence[str], columns: Sequence[str]) -> list[Column]:
    """Sort order given as text, such as ``'ItemName ASC, Price DESC NULLS LAST'``.

    Every name must be one of `columns` and only the direction words are
    understood, so the text cannot carry other SQL. NULLs come first in
    ascending and last in descending order unless stated.
    """
    items = spec.split(",") if isinstance(spec, str) else list(spec)
    out = []
    for item in items:
        m = re.fullmatch(r"\s*`?([^`\s]+)`?(?:\s+(asc|desc))?(?:\s+nulls\s+(first|last))?\s*", item, re.IGNORECASE)
        if m is None:
            raise InvalidInputError(f"Cannot read the sort order {item!r}", data=spec)
        name, direction, nulls = m.group(1), (m.group(2) or "asc").lower(), (m.group(3) or "").lower()
        check_columns([name], columns)
        nulls = nulls or ("first" if direction == "asc" else "last")
        out.append(getattr(quoted(name), f"{direction}_nulls_{nulls}")())
    return out
