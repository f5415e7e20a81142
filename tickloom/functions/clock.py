"""Times without the session's zone: epoch microseconds, and clocks as timestamp_ntz.

A timestamp is an instant; a timestamp_ntz is taken as a clock in UTC. Nothing here reads
spark.sql.session.timeZone, so that results are the same in every session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Microseconds of the units that time can be cut to.
WIDTHS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def utc_clock(micros: Column) -> Column:
    """Epoch microseconds as the clock in UTC."""
    seconds = (micros.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return _epoch() + F.make_dt_interval(secs=seconds)


def clock_micros(clock: Column) -> Column:
    """Microseconds from 1970 to a clock."""
    seconds = (clock - _epoch()).cast("interval second").cast("decimal(18,6)")
    return (seconds * 1_000_000).cast("long")


def epoch_micros(df: DataFrame, ts: str) -> Column:
    """Epoch microseconds of a column that is an instant or a clock in UTC."""
    kind = df.schema[ts].dataType
    return clock_micros(F.col(ts)) if isinstance(kind, T.TimestampNTZType) else F.unix_micros(F.col(ts).cast("timestamp"))


def at_zone(clock: Column, zone: str) -> Column:
    """A clock in UTC as the clock in zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), clock)


def from_zone(clock: Column, zone: str) -> Column:
    """A clock in zone as the clock in UTC."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), clock)


def floored(micros: Column, unit: str) -> Column:
    """The instant at which the unit of epoch microseconds began."""
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(WIDTHS[unit])))


def minute_of_day(clock: Column) -> Column:
    return F.hour(clock) * 60 + F.minute(clock)
