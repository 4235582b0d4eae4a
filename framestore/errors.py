"""Exceptions raised by framestore.

Every class carries an optional ``data`` attribute with the values that caused
the error, so that callers can react without parsing the message.
"""

from __future__ import annotations

from typing import Any


class FramestoreError(Exception):
    """Base of all errors of this package."""

    def __init__(self, message: str, data: Any = None) -> None:
        super().__init__(message)
        self.data = data


class InvalidInputError(FramestoreError):
    """A parameter has a wrong type or value."""


class TableStoreError(FramestoreError):
    """Base of the errors of table work."""


class SourceNotFoundError(TableStoreError):
    """The table, path or database that must exist is absent."""


class DataTypeConversionError(TableStoreError):
    """A requested cast names an unknown column or type, or fails on values."""


class DeleteFromTableError(TableStoreError):
    """Rows of a table could not be deleted."""


class ExecuteStatementError(TableStoreError):
    """A statement, update, upsert or merge could not be executed."""


class InvalidColumnNameError(TableStoreError):
    """A column is not part of the DataFrame or of the table."""


class InvalidTableNameError(TableStoreError):
    """A table name is not a single word."""


class LoadTableError(TableStoreError):
    """A table or query could not be loaded."""


class SaveDataFrameError(TableStoreError):
    """A DataFrame could not be saved to a table."""


class SetIndexError(TableStoreError):
    """The requested key columns are not columns of the result."""


class SQLStatementNotSupportedError(TableStoreError):
    """The table format does not support the requested native statement."""


class TableExistsError(TableStoreError):
    """The table exists although it must not."""
