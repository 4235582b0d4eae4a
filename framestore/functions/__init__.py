"""Column functions: datetimes, parsing and casts, missing values."""

from framestore.functions.datetimes import convert_datetime_columns
from framestore.functions.nulls import nan_to_null
from framestore.functions.parsing import cast_columns, coerce_decimals, parse_dates

__all__ = ["cast_columns", "coerce_decimals", "convert_datetime_columns", "nan_to_null", "parse_dates"]
