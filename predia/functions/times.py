"""Time expressions. The clock is always a parameter, so that a run can be repeated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from predia.fixed_values import LOCAL_ZONE, TIME_PATTERN


def clock(as_of: dt.datetime | str | None = None) -> Column:
    """The given instant, or the instant the query starts."""
    return F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")


def parse_time(value: Column, pattern: str = TIME_PATTERN) -> Column:
    """A timestamp from a timestamp, from its normal text, or else from text in ``pattern``."""
    return F.coalesce(value.try_cast("timestamp"), F.try_to_timestamp(value.cast("string"), F.lit(pattern)))


def days_since(as_of: Column, moment: Column) -> Column:
    """Whole calendar days from ``moment`` to ``as_of``."""
    return F.datediff(as_of, moment)


def clock_text(as_of: Column, zone: str = LOCAL_ZONE) -> Column:
    """``as_of`` (an instant) as date-time text of a fixed zone, whatever the zone of the session."""
    there = F.convert_timezone(None, F.lit(zone), as_of.cast("timestamp").cast("timestamp_ntz"))
    return F.date_format(there, "yyyy-MM-dd HH:mm:ss")
