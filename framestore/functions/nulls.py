"""Missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, FloatType

from framestore.functions.project import ident, project


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every float and double column with one projection.

    There is no scan to find out whether a NaN occurs: the expression costs
    nothing next to reading the column.
    """
    schema = df.schema
    if not any(isinstance(f.dataType, (FloatType, DoubleType)) for f in schema):
        return df
    return project(
        df,
        {
            f.name: f"CASE WHEN NOT isnan({ident(f.name)}) THEN {ident(f.name)} END"
            if isinstance(f.dataType, (FloatType, DoubleType))
            else ident(f.name)
            for f in schema
        },
    )
