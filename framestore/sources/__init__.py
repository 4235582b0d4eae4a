"""Sources: tables and queries of the Spark catalog, and JDBC databases."""

from framestore.sources.jdbc import JdbcSource
from framestore.sources.load import keys_first, shape_rows

__all__ = ["JdbcSource", "keys_first", "shape_rows"]
