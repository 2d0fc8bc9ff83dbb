"""RFC 3339 checks and reading of date-only or full timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted form of a timestamp.
RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def is_rfc3339(text: Column) -> Column:
    return text.rlike(RFC3339)


def instant(text: Column) -> Column:
    """Full timestamp, or a date taken as midnight UTC, as a UTC timestamp without zone; else null."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def start_instant(when: Column) -> Column:
    """Instant of an event bound ``struct<dateTime,date>``: the time if given, else the day."""
    return instant(F.coalesce(when["dateTime"], when["date"]))


def literal_instant(text: str) -> Column:
    """A bound given as text (timestamp or date) as a literal in UTC, whatever the session's zone."""
    when = dt.datetime.fromisoformat(text)
    if when.tzinfo is not None:
        when = when.astimezone(dt.UTC).replace(tzinfo=None)
    return F.lit(when.isoformat(" ")).cast("timestamp_ntz")
