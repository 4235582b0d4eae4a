"""Parsing of text and numbers into datetimes, and casts by type name."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    NumericType,
    StructField,
    TimestampNTZType,
    TimestampType,
)

from framestore.errors import DataTypeConversionError, InvalidInputError, LoadTableError
from framestore.functions.datetimes import TZ_KEY
from framestore.functions.strftime import has_directive, parse_patterns
from framestore.session import require_utc
from framestore.validation import check_choice

EPOCH_UNITS = ("D", "s", "ms", "us", "ns")
PARSE_OPTIONS = ("format", "unit", "errors", "utc")

# Type names of DataFrame libraries -> Spark type.
TYPE_NAMES = {
    "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "int": "bigint",
    "uint8": "smallint", "uint16": "int", "uint32": "bigint", "uint64": "decimal(20,0)",
    "float32": "float", "float64": "double", "float": "double", "double": "double",
    "str": "string", "string": "string", "object": "string", "category": "string",
    "bool": "boolean", "boolean": "boolean",
    "datetime64": "timestamp_ntz", "datetime64[ns]": "timestamp_ntz", "datetime64[us]": "timestamp_ntz",
}
# Largest value of the unsigned types, which Spark lacks.
UNSIGNED_MAX = {"uint8": 2**8 - 1, "uint16": 2**16 - 1, "uint32": 2**32 - 1, "uint64": 2**64 - 1}
# A UTC offset or Z at the end of a text with a time of day.
_OFFSET = r"\d{1,2}:\d{2}.*(Z|[+-]\d{1,2}(:?\d{2})?)$"
_PYTHON_TYPES = {int: "int64", float: "float64", str: "string", bool: "boolean"}


def coerce_decimals(df: DataFrame) -> DataFrame:
    """Decimal columns as double."""
    if not any(isinstance(f.dataType, DecimalType) for f in df.schema):
        return df
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name, metadata=f.metadata)
            if isinstance(f.dataType, DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def parse_epoch(col: Column, unit: str) -> Column:
    """A count of `unit` since 1970-01-01 as a naive timestamp."""
    if unit == "D":
        instant = F.timestamp_seconds(col * 86400)
    elif unit == "s":
        instant = F.timestamp_seconds(col)
    elif unit == "ms":
        instant = F.timestamp_millis(col.cast("bigint"))
    elif unit == "us":
        instant = F.timestamp_micros(col.cast("bigint"))
    else:
        nanos = col.cast("bigint")
        instant = F.timestamp_micros(F.call_function("div", nanos - F.pmod(nanos, F.lit(1000)), F.lit(1000)))
    return instant.cast("timestamp_ntz")


def parse_text(col: Column, fmt: str | None, errors: str) -> Column:
    """Text as a naive timestamp (an instant if the format reads a UTC offset).

    Without a format any ISO text is read, also one that stops at the day or minute; text
    that carries a UTC offset gives its UTC time. With a format, days, months, hours, minutes
    and seconds may have one digit where the format separates them, a format that ends with seconds
    also reads text without them, and two-digit years from 69 on are of the 20th century. `errors`:
    'coerce' gives NULL for text that does not match, 'raise' fails the query.
    """
    if fmt is None:
        zoned = F.trim(col).rlike(_OFFSET)
        if errors == "coerce":
            return F.when(zoned, col.try_cast("timestamp").cast("timestamp_ntz")).otherwise(col.try_cast("timestamp_ntz"))
        return F.when(zoned, col.cast("timestamp").cast("timestamp_ntz")).otherwise(col.cast("timestamp_ntz"))
    patterns = parse_patterns(fmt)
    found = F.coalesce(*[F.try_to_timestamp(col, F.lit(p)) for p in patterns])
    if errors == "raise":
        found = F.when(found.isNull() & col.isNotNull(), F.to_timestamp(col, patterns[0])).otherwise(found)
    if has_directive(fmt, "y"):
        found = F.when(F.year(found) >= 2069, found - F.make_interval(years=F.lit(100))).otherwise(found)
    return found if has_directive(fmt, "z") else found.cast("timestamp_ntz")


def parse_dates(df: DataFrame, spec: str | list | tuple | dict[str, Any] | bool | None) -> DataFrame:
    """Parse columns into datetimes.

    `spec` is a column name or names, or a dict column -> strftime format, epoch
    unit (D, s, ms, us, ns) or options (``format``, ``unit``, ``errors``,
    ``utc``). Text that does not match becomes NULL, unless the options say
    otherwise. A numeric column without a format holds seconds. Unknown names
    are ignored.
    """
    if not spec or spec is True:
        return df
    if isinstance(spec, str):
        wanted: dict[str, Any] = {spec: None}
    elif isinstance(spec, dict):
        wanted = spec
    elif isinstance(spec, (list, tuple, set)):
        wanted = dict.fromkeys(spec)
    else:
        raise LoadTableError(f"parse_dates must be a name, a list or a dict, got {type(spec)}", data=spec)
    fields = [f for f in df.schema if f.name in wanted]
    if not fields:
        return df
    require_utc(df.sparkSession)
    parsed = {f.name: _parse_field(f, wanted[f.name]) for f in fields}
    return df.select(*[parsed.get(f.name, F.col(f"`{f.name}`")) for f in df.schema])


def _parse_field(field: StructField, how: Any) -> Column:
    options = dict(how) if isinstance(how, dict) else {}
    unknown = [k for k in options if k not in PARSE_OPTIONS]
    if unknown:
        raise InvalidInputError(f"Unsupported parse options {unknown} for column {field.name}", data=how)
    errors = check_choice("errors", options.get("errors", "raise" if options else "coerce"), ("raise", "coerce"))
    fmt, unit = options.get("format"), options.get("unit")
    if isinstance(how, str):
        fmt, unit = (None, how) if how in EPOCH_UNITS else (how, None)
    if unit is not None:
        check_choice("unit", unit, EPOCH_UNITS)

    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
        out = col
    elif isinstance(field.dataType, DateType):
        out = col.cast("timestamp_ntz")
    elif isinstance(field.dataType, NumericType):
        out = parse_epoch(col, unit or "s") if fmt is None else parse_text(col.cast("string"), fmt, errors)
    elif unit is not None:
        number = col.try_cast("bigint") if errors == "coerce" else col.cast("bigint")
        out = parse_epoch(number, unit)
    else:
        out = parse_text(col, fmt, errors)
    metadata = field.metadata or {}
    if options.get("utc"):
        out, metadata = out.cast("timestamp"), {**metadata, TZ_KEY: "UTC"}
    return out.alias(field.name, metadata=metadata)


def type_and_limit(dtype: Any) -> tuple[str | DataType, int | None]:
    """The Spark type for `dtype`, and the largest value if it is an unsigned type."""
    if isinstance(dtype, DataType):
        return dtype, None
    name = _PYTHON_TYPES.get(dtype, dtype) if isinstance(dtype, type) else dtype
    if not isinstance(name, str):
        name = getattr(name, "name", None) or str(name)
    low = name.lower()
    if low in TYPE_NAMES:
        return TYPE_NAMES[low], UNSIGNED_MAX.get(low)
    try:
        return DataType.fromDDL(name), None
    except Exception as e:
        raise DataTypeConversionError(f"{dtype!r} is the name of no type", data=(e.args, dtype)) from None


def cast_columns(df: DataFrame, dtypes: dict[str, Any] | Any | None, validate: bool = False) -> DataFrame:
    """Cast columns to the types in `dtypes` (one type for all columns if no dict).

    Names and types are checked now. Values are checked when the query runs: a
    value that does not fit fails it. `validate` runs one aggregation first and
    raises `DataTypeConversionError` with the number of bad values per column.
    """
    if dtypes is None:
        return df
    wanted = dtypes if isinstance(dtypes, dict) else dict.fromkeys(df.columns, dtypes)
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise DataTypeConversionError(
            f"dtypes names columns that do not exist: {missing} (there are {df.columns})",
            data=(df.columns, dtypes, missing),
        )
    types = {c: type_and_limit(t) for c, t in wanted.items()}
    if validate:
        _check_values(df, types)
    fields = {f.name: f for f in df.schema}
    return df.select(
        *[
            _cast(F.col(f"`{c}`"), *types[c]).alias(c, metadata=fields[c].metadata) if c in types else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def _cast(col: Column, dtype: str | DataType, limit: int | None) -> Column:
    cast = col.cast(dtype)
    if limit is None:
        return cast
    fits = col.isNull() | ((col >= 0) & (col <= F.lit(limit)))
    message = F.concat(F.lit(f"Value outside 0..{limit}: "), col.cast("string"))
    return F.when(fits, cast).otherwise(F.raise_error(message).cast(dtype))


def _check_values(df: DataFrame, types: dict[str, tuple[str | DataType, int | None]]) -> None:
    counts = []
    for name, (dtype, limit) in types.items():
        col = F.col(f"`{name}`")
        bad = col.isNotNull() & col.try_cast(dtype).isNull()
        if limit is not None:
            bad = bad | ((col < 0) | (col > F.lit(limit)))
        counts.append(F.count_if(bad).alias(name))
    found = df.agg(*counts).first().asDict()
    bad_columns = {c: n for c, n in found.items() if n}
    if bad_columns:
        raise DataTypeConversionError(f"Values that cannot be converted, per column: {bad_columns}", data=bad_columns)
