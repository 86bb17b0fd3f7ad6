"""Time conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_text_to_time_text(seconds: str) -> Column:
    """Unix seconds held as text to a time as text; empty or malformed text gives NULL."""
    return F.from_unixtime(F.col(seconds).try_cast("bigint"))


def nanos_to_timestamp(nanos: str) -> Column:
    return F.timestamp_micros(F.expr(f"{nanos} div 1000"))


def epoch_to_timestamp(seconds: str) -> Column:
    """Unix seconds with a fraction to a timestamp."""
    return F.col(seconds).cast("timestamp")


def plain(time: str | Column) -> Column:
    """A UTC timestamp without zone, as the SQL side has it."""
    return F.col(time).cast("timestamp_ntz") if isinstance(time, str) else time.cast("timestamp_ntz")
