"""Datetime columns: localize, convert, and turn into text or epoch seconds.

A naive column is a ``TimestampNTZType`` column. An aware column is a
``TimestampType`` column, an instant; its zone name is kept in the field
metadata under ``tz`` (no entry means the session zone, UTC). Spark drops
metadata when an expression is applied, so it is attached last.
"""

from __future__ import annotations

import warnings
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, TimestampNTZType, TimestampType

from framestore.errors import InvalidInputError
from framestore.functions.project import ident
from framestore.functions.strftime import format_wall_clock, split_format
from framestore.session import require_utc
from framestore.validation import check_choice

TZ_KEY = "tz"
DEFAULT_FORMAT = "%Y-%m-%d %H:%M:%S"
DST_MODES = ("raise", "shift", "null")


def check_zone(name: str | None, what: str) -> str | None:
    """Return the zone name if it is known."""
    if name is None:
        return None
    try:
        ZoneInfo(name)
    except Exception as e:
        raise InvalidInputError(f"Unknown time zone {what}={name!r}", data=(name, e.args)) from None
    return name


def column_zone(field: StructField) -> str | None:
    """Zone name of an aware column, None for any other column."""
    if not isinstance(field.dataType, TimestampType):
        return None
    return (field.metadata or {}).get(TZ_KEY, "UTC")


def is_datetime(field: StructField) -> bool:
    return isinstance(field.dataType, (TimestampType, TimestampNTZType))


_DAY_MICROS = 24 * 3600 * 1_000_000


# With the session zone UTC a naive timestamp and the instant of the same digits have
# the same microseconds. Spark resolves a constant zone of from_utc_timestamp and
# to_utc_timestamp once per task, not per row as convert_timezone does.


def _micros(naive: Column) -> Column:
    return F.unix_micros(naive.cast("timestamp"))


def _utc_micros(naive: Column, tz: str) -> Column:
    return F.unix_micros(F.to_utc_timestamp(naive.cast("timestamp"), tz))


def _local_micros(utc_micros: Column, tz: str) -> Column:
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(utc_micros), tz))


def _offsets_around(naive: Column, tz: str) -> tuple[Column, Column]:
    """Offsets from UTC one day before and one day after. They differ only near a clock change."""
    utc = _utc_micros(naive, tz)
    before, after = utc - F.lit(_DAY_MICROS), utc + F.lit(_DAY_MICROS)
    return _local_micros(before, tz) - before, _local_micros(after, tz) - after


def _fits(naive: Column, offset: Column, tz: str) -> Column:
    """True if the local time occurs with this offset."""
    return _local_micros(_micros(naive) - offset, tz) == _micros(naive)


def dst_gap(naive: Column, tz: str) -> Column:
    """True where the local time does not exist (clock set forward)."""
    before, after = _offsets_around(naive, tz)
    return F.when(before == after, F.lit(False)).otherwise(~_fits(naive, before, tz) & ~_fits(naive, after, tz))


def dst_ambiguous(naive: Column, tz: str) -> Column:
    """True where the local time occurs twice (clock set back)."""
    before, after = _offsets_around(naive, tz)
    return F.when(before == after, F.lit(False)).otherwise(_fits(naive, before, tz) & _fits(naive, after, tz))


def localize(naive: Column, tz: str, dst: str = "raise") -> Column:
    """The instant of the local time `naive` in zone `tz`.

    `dst` says what happens to local times that do not exist or occur twice:
    'raise' fails the query, 'null' gives NULL, 'shift' takes Spark's choice.
    """
    if tz in ("UTC", "Etc/UTC", "GMT"):
        return naive.cast("timestamp")
    instant = F.to_utc_timestamp(naive.cast("timestamp"), tz)
    if dst == "shift":
        return instant
    before, after = _offsets_around(naive, tz)
    # Away from clock changes the first test decides; near one, exactly one offset must fit.
    checked = F.when(naive.isNull() | (before == after), instant).when(
        _fits(naive, before, tz) != _fits(naive, after, tz), instant
    )
    if dst == "null":
        return checked
    message = F.concat(F.lit(f"Non-existent or ambiguous local time in {tz}: "), naive.cast("string"))
    return checked.otherwise(F.raise_error(message).cast("timestamp"))


def wall_clock(instant: Column, tz: str | None) -> Column:
    """The timestamp whose digits in UTC are the local time of `instant` in zone `tz`."""
    return instant if tz in (None, "UTC") else F.from_utc_timestamp(instant, tz)


def epoch_seconds(col: Column) -> Column:
    """Whole seconds since 1970-01-01, rounded down also before 1970."""
    return F.unix_seconds(col.cast("timestamp"))


def _offset_at_epoch(tz: str) -> int:
    """Seconds between local midnight of 1970-01-01 in `tz` and the Unix epoch."""
    from datetime import datetime

    return int(datetime(1970, 1, 1, tzinfo=ZoneInfo(tz)).utcoffset().total_seconds())


def convert_datetime_columns(
    df: DataFrame,
    dtype: str | None = None,
    datetime_format: str = DEFAULT_FORMAT,
    localize_tz: str | None = None,
    target_tz: str | None = None,
    dst: str = "raise",
    local_epoch: bool = False,
) -> DataFrame:
    """Convert every datetime column of `df` in one projection.

    Naive columns are localized into `localize_tz`; aware columns (also those
    just localized) are converted to `target_tz`; then the columns are kept
    (`dtype` None), formatted with the strftime format ('str') or turned into
    seconds since the Unix epoch ('int').

    `local_epoch` counts 'int' values of a column outside UTC from 1970-01-01
    local time instead of from the Unix epoch.
    """
    check_choice("dtype", dtype, ("str", "int", None))
    check_choice("dst", dst, DST_MODES)
    check_zone(localize_tz, "localize_tz")
    check_zone(target_tz, "target_tz")
    if dtype == "str":
        split_format(datetime_format)
    fields = [f for f in df.schema if is_datetime(f)]
    if not fields or (dtype is None and localize_tz is None and target_tz is None):
        return df
    require_utc(df.sparkSession)

    localized: dict[str, Column] = {}
    zones: dict[str, str | None] = {}
    for field in fields:
        name, zone = field.name, column_zone(field)
        if zone is None and localize_tz is not None:
            localized[name], zone = localize(F.col(ident(name)), localize_tz, dst), localize_tz
        if target_tz is not None and target_tz != zone:
            if zone is None:
                raise InvalidInputError(
                    f"Column {name} has no time zone, so it cannot be brought to {target_tz}; set localize_tz first",
                    data=target_tz,
                )
            zone = target_tz
        zones[name] = zone

    names = df.columns
    # Columns of their own, so that Spark computes the instant and the local time once per row.
    rows = df.withColumns(localized) if localized else df
    walls = {}
    if dtype == "str":
        walls = {n: f"__wall_{i}" for i, (n, z) in enumerate(zones.items()) if z is not None}
        rows = rows.withColumns({w: wall_clock(F.col(ident(n)), zones[n]) for n, w in walls.items()})
    return rows.select(
        *[
            _as_dtype(n, zones[n], walls.get(n, n), dtype, datetime_format, target_tz, local_epoch)
            if n in zones
            else F.col(ident(n))
            for n in names
        ]
    )


def _as_dtype(name, zone, wall_name, dtype, datetime_format, target_tz, local_epoch) -> Column:
    col = F.col(ident(name))
    if dtype is None:
        return col if zone is None else col.alias(name, metadata={TZ_KEY: zone})
    if dtype == "str":
        wall = F.col(ident(wall_name))
        offset = None if zone is None else epoch_seconds(wall) - epoch_seconds(col)
        return format_wall_clock(wall, datetime_format, offset, zone).alias(name)
    seconds = epoch_seconds(col)
    if zone not in (None, "UTC"):
        warnings.warn(
            f"Epoch seconds of {name} are counted from its instants; its wall clock is {zone}",
            UserWarning,
            stacklevel=4,
        )
        if local_epoch:
            seconds = seconds + F.lit(_offset_at_epoch(zone))
    return seconds.alias(name)
