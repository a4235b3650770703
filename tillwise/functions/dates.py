"""Local dates, date bounds and trading weeks.

Transaction times are UTC without a zone (``timestamp_ntz``), so none of these
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwise.config import LOCAL_ZONE, RANGE_OFFSET

# Any Wednesday; weeks are counted from it.
FIRST_WEEK = "1969-12-31"


def local_date(utc: Column, zone: str = LOCAL_ZONE) -> Column:
    """Calendar date at ``zone`` of a UTC time, daylight saving included."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc))


def utc_bound(date: str, time: str, offset: str = RANGE_OFFSET) -> Column:
    """A wall-clock time at a fixed offset, as a UTC ``timestamp_ntz``."""
    local = F.lit(f"{date} {time}").cast("timestamp_ntz")
    return F.convert_timezone(F.lit(offset), F.lit("UTC"), local)


def in_local_range(utc: Column, start: str, end: str, offset: str = RANGE_OFFSET) -> Column:
    """Both whole days included. The raw column stands alone on the left and the
    bounds fold to constants, so the test reaches the scan and prunes."""
    return utc.between(
        utc_bound(start, "00:00:00", offset), utc_bound(end, "23:59:59", offset)
    )


def week_start(date: Column) -> Column:
    """The Wednesday on or before ``date``."""
    return F.date_sub(date, F.pmod(F.weekday(date) - F.lit(2), F.lit(7)).cast("int"))


def week_index(date: Column) -> Column:
    """Weeks since a fixed Wednesday: one integer per trading week."""
    first = F.lit(FIRST_WEEK).cast("date")
    return F.floor(F.datediff(week_start(date), first) / F.lit(7)).cast("int")


def week_of_year(date: Column) -> Column:
    """Number of the trading week within its year, from 0."""
    return F.floor((F.dayofyear(week_start(date)) - F.lit(1)) / F.lit(7)).cast("int")
