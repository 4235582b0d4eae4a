"""Projections written as SQL text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType


def ident(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def project(df: DataFrame, columns: dict[str, str], schema: StructType | None = None) -> DataFrame:
    """Select SQL expressions by name, keeping the field metadata in `schema` (of `df` if None).

    An expression loses the metadata of its column, such as its time zone.
    """
    kept = {f.name: f.metadata for f in (schema or df.schema) if f.metadata and f.name in columns}
    if not kept:
        return df.selectExpr(*[f"{sql} AS {ident(name)}" for name, sql in columns.items()])
    return df.select(
        *[
            F.expr(sql).alias(name, metadata=kept[name]) if name in kept else F.expr(sql).alias(name)
            for name, sql in columns.items()
        ]
    )


def pick(df: DataFrame, columns: Sequence[str], *more: str) -> DataFrame:
    """The columns of `df` with these names, and further SQL expressions."""
    return df.selectExpr(*[ident(c) for c in columns], *more)
