"""Short names of time zones (CET, CEST, ...) at an instant, from a table of the changes of each zone."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F

#: Years whose changes are looked up. The rules of the last ones go on, and the calendar repeats every 400 years.
FIRST_YEAR, STOP_YEAR, PERIOD_YEARS = 1800, 2600, 400
_PERIOD_SECONDS = 146097 * 86400
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _name_at(zone: ZoneInfo, second: int) -> str:
    return (_EPOCH + timedelta(seconds=second)).astimezone(zone).tzname()


@lru_cache(maxsize=64)
def names_by_year(tz: str) -> tuple[tuple[tuple[int, str], ...], ...]:
    """For each year the names that apply in it, each with the second from which on, the first as of the start of the year.

    A change is found by halving the day in which the name differs.
    """
    zone, years = ZoneInfo(tz), []
    for year in range(FIRST_YEAR, STOP_YEAR):
        start = int((datetime(year, 1, 1, tzinfo=timezone.utc) - _EPOCH).total_seconds())
        stop = int((datetime(year + 1, 1, 1, tzinfo=timezone.utc) - _EPOCH).total_seconds())
        changes = [(start, _name_at(zone, start))]
        for day in range(start, stop, 86400):
            end = min(day + 86400, stop)
            while _name_at(zone, end) != changes[-1][1]:
                lo, hi = max(day, changes[-1][0]), end
                while hi - lo > 1:
                    middle = (lo + hi) // 2
                    lo, hi = (middle, hi) if _name_at(zone, middle) == changes[-1][1] else (lo, middle)
                changes.append((hi, _name_at(zone, hi)))
        years.append(tuple(c for c in changes if c[0] < stop))
    return tuple(years)


def zone_name(seconds: Column, tz: str) -> Column:
    """The short name of zone `tz` at an instant, in seconds since the Unix epoch.

    The table is one constant. A row looks at the few changes of its year.
    """
    if tz == "UTC":
        return F.lit("UTC")
    text = json.dumps([[{"at": at, "name": name} for at, name in year] for year in names_by_year(tz)])
    years = F.from_json(F.lit(text), "array<array<struct<at:bigint,name:string>>>")
    early = F.lit(int((datetime(STOP_YEAR - PERIOD_YEARS, 1, 1, tzinfo=timezone.utc) - _EPOCH).total_seconds()))
    periods = F.greatest(F.lit(0), F.floor((seconds - early) / _PERIOD_SECONDS))
    second = seconds - periods * _PERIOD_SECONDS
    year = F.greatest(F.year(F.timestamp_seconds(second)), F.lit(FIRST_YEAR))
    changes = F.element_at(years, year - FIRST_YEAR + 1)
    begun = F.filter(changes, lambda c: c["at"] <= second)
    return F.coalesce(F.try_element_at(begun, F.lit(-1))["name"], F.when(seconds.isNotNull(), F.element_at(changes, 1)["name"]))
