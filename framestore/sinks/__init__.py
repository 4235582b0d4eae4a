"""Sinks: publishing rows to catalog tables."""

from framestore.sinks.publish import replace_partitions, replace_rows, table_info

__all__ = ["replace_partitions", "replace_rows", "table_info"]
