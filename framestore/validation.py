"""Checks of user input. They look at arguments and schemas only: no Spark job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from typing import Any

from framestore.errors import InvalidColumnNameError, InvalidInputError, InvalidTableNameError


def check_table_name(table: Any) -> str:
    """Return `table` if it is a string of one word."""
    if not isinstance(table, str):
        raise InvalidInputError(f"table must be a string, got {type(table)} ({table})", data=table)
    if not table or any(ch.isspace() for ch in table):
        raise InvalidTableNameError(f"The table name must be a single word, got {table!r}", data=table)
    return table


def is_table_name(sql: str) -> bool:
    """True if `sql` is one word, thus a table name and not a query."""
    return bool(sql) and not any(ch.isspace() for ch in sql.strip())


def check_chunksize(chunksize: Any) -> int | None:
    """Return `chunksize` if it is None or an integer above zero."""
    if chunksize is None:
        return None
    if isinstance(chunksize, bool) or not isinstance(chunksize, int):
        raise InvalidInputError(f"chunksize must be an int or None, got {type(chunksize)}", data=chunksize)
    if chunksize <= 0:
        raise InvalidInputError(f"chunksize must be above zero, got {chunksize}", data=chunksize)
    return chunksize


def check_choice(name: str, value: Any, choices: Sequence[Any]) -> Any:
    """Return `value` if it is one of `choices` (compared by type and value)."""
    if not any(type(value) is type(c) and value == c for c in choices):
        raise InvalidInputError(f"Invalid {name} = {value!r}. Valid options: {list(choices)}", data=(value, choices))
    return value


def as_list(value: str | Iterable[str] | None) -> list[str]:
    """A name, a sequence of names or None as a list of names without repeats."""
    if value is None:
        return []
    names = [value] if isinstance(value, str) else list(value)
    return list(dict.fromkeys(names))


def check_columns(names: Iterable[str], available: Sequence[str], what: str = "DataFrame") -> list[str]:
    """Return `names` as a list if all of them are in `available`."""
    names = list(names)
    invalid = [n for n in names if n not in available]
    if invalid:
        raise InvalidColumnNameError(
            f"The {what} has no columns {invalid}, only {list(available)}", data=invalid
        )
    return names


@dataclass(frozen=True)
class ColumnPlan:
    """Which columns an upsert or merge matches on, updates and inserts."""

    keys: tuple[str, ...]
    update: tuple[str, ...]
    insert: tuple[str, ...]

    @property
    def needed(self) -> list[str]:
        return list(dict.fromkeys(self.keys + self.insert))


def plan_columns(
    df_columns: Sequence[str],
    keys: str | Sequence[str],
    chosen: str | Sequence[str] | None = "all",
    index_cols: str | Sequence[str] | None = None,
    chosen_index: bool | str | Sequence[str] = False,
) -> ColumnPlan:
    """Resolve the column sets of an upsert or merge.

    `chosen` is ``'all'`` (every column that is not one of `index_cols`), names,
    or None for none. `chosen_index` adds all of `index_cols` (True) or the named
    ones. The update set is the chosen columns without the keys, the insert set
    is the chosen columns.
    """
    key_list = as_list(keys)
    if not key_list:
        raise InvalidInputError("At least one key column is needed", data=keys)
    index_list = as_list(index_cols)
    if isinstance(chosen, str) and chosen == "all":
        selected = [c for c in df_columns if c not in index_list]
    else:
        selected = as_list(chosen)
    if chosen_index is True:
        selected += index_list
    elif chosen_index is not False:
        selected += as_list(chosen_index)
    selected = list(dict.fromkeys(selected))
    check_columns(dict.fromkeys(selected + key_list + index_list), df_columns)
    return ColumnPlan(
        keys=tuple(key_list),
        update=tuple(c for c in selected if c not in key_list),
        insert=tuple(selected),
    )
