"""Calendar parts of zone-free timestamps. No expression here looks at the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names in report order.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("long")


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def day_name(ts: Column) -> Column:
    """Full English weekday name. Goes by the date: formatting the time itself would pass through the session zone."""
    return F.date_format(F.to_date(ts), "EEEE")


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def floor_hour(ts: Column) -> Column:
    return F.timestamp_add("HOUR", F.hour(ts), F.to_date(ts).cast("timestamp_ntz"))


def floor_second(ts: Column) -> Column:
    """Capture times are kept to the second."""
    seconds = minute_of_day(ts) * 60 + F.second(ts)
    return F.timestamp_add("SECOND", seconds, F.to_date(ts).cast("timestamp_ntz"))


def utc_wall_clock(instant: Column) -> Column:
    """A zoned timestamp as zone-free UTC, whatever the session time zone is."""
    return _after_epoch(F.unix_micros(instant))


def from_epoch_nanos(nanos: Column) -> Column:
    """Nanoseconds since 1970 as zone-free UTC, cut to microseconds."""
    return _after_epoch(F.call_function("div", nanos, F.lit(1000)))


def _after_epoch(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
