"""framestore: load, save, upsert and merge tables with Spark DataFrames."""

from framestore import errors
from framestore.operators.checks import Constraints, ForeignKey
from framestore.operators.params import Placeholder, filter_in, replace_placeholders, sort_columns
from framestore.sources.jdbc import JdbcSource
from framestore.store import ChangeCounts, TableStore

__all__ = [
    "ChangeCounts",
    "Constraints",
    "ForeignKey",
    "JdbcSource",
    "Placeholder",
    "TableStore",
    "errors",
    "filter_in",
    "replace_placeholders",
    "sort_columns",
]
