"""Instants (UTC) and Shanghai wall time.

The conversions count on a session in UTC. They use the pair of functions that look up
a constant zone once per query and not once per row.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

SHANGHAI = "Asia/Shanghai"
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
WALL_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
MID_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})?Z?$"


def as_instant(now: datetime | Column) -> Column:
    """A point in time given by the caller; a naive datetime is read as UTC."""
    if isinstance(now, Column):
        return now
    return F.lit(now if now.tzinfo else now.replace(tzinfo=timezone.utc)).cast("timestamp")


def shanghai_to_utc(wall: Column) -> Column:
    """Shanghai wall time (no zone) -> instant."""
    return F.to_utc_timestamp(wall.cast("timestamp"), SHANGHAI)


def utc_to_shanghai(instant: Column) -> Column:
    """Instant -> Shanghai wall time (no zone)."""
    return F.from_utc_timestamp(instant, SHANGHAI).cast("timestamp_ntz")


def iso_millis(instant: Column) -> Column:
    return F.date_format(instant, ISO_MILLIS)


def parse_wall(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` exactly -> wall time; any other text -> null."""
    return F.when(text.rlike(WALL_PATTERN), text.try_cast("timestamp_ntz"))


def parse_mid_time(text: Column) -> Column:
    """ISO-8601 or SQL timestamp text, UTC -> instant; any other text -> null."""
    return F.when(text.rlike(MID_PATTERN), text.try_cast("timestamp"))
