"""Instants from the forms that sources write them in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_epoch_millis(column: Column) -> Column:
    """Epoch milliseconds as a UTC wall-clock timestamp without zone, millis kept."""
    seconds = (column.cast("decimal(20,3)") / F.lit(1000)).cast("decimal(20,6)")
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def parse_iso(column: Column) -> Column:
    """ISO date-times with an optional ``[zone]`` suffix and optional seconds.

    Returns a zoned timestamp; text that is no date-time gives NULL.
    """
    bare = F.regexp_replace(column, r"\[[^\]]*\]$", "")
    full = F.regexp_replace(bare, r"T(\d{2}:\d{2})(Z|[+-]\d{2}:?\d{2})?$", "T$1:00$2")
    return full.try_cast("timestamp")


def parse_duration(column: Column) -> Column:
    """ISO durations such as ``P163DT12H`` or ``PT1H3M5.533S`` as day-time intervals."""
    shape = r"^P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?$"

    def part(group: int, kind: str) -> Column:
        return F.coalesce(F.regexp_extract(column, shape, group).try_cast(kind), F.lit(0))

    whole = column.rlike(shape) & column.rlike(r"\d[DHMS]")
    return F.when(whole, F.make_dt_interval(
        part(1, "int"), part(2, "int"), part(3, "int"), part(4, "decimal(18,6)")))


def seconds_of(interval: Column) -> Column:
    """Length of a day-time interval in seconds, fractions kept."""
    return interval.cast("interval second").cast("decimal(24,6)")


def time_to_nanos(column: Column) -> Column:
    """Time of day ``HH:mm[:ss[.fraction]]`` as nanoseconds since midnight.

    Parquet takes no time-of-day type, so a whole number is what gets stored.
    """
    shape = r"^([01]\d|2[0-3]):([0-5]\d)(?::([0-5]\d)(?:\.(\d{1,9}))?)?$"
    hours, minutes, seconds = (
        F.coalesce(F.regexp_extract(column, shape, g).try_cast("bigint"), F.lit(0)) for g in (1, 2, 3))
    fraction = F.rpad(F.regexp_extract(column, shape, 4), 9, "0").cast("bigint")
    return F.when(
        column.rlike(shape),
        ((hours * 60 + minutes) * 60 + seconds) * F.lit(1_000_000_000) + fraction)


def period(start: Column, end: Column) -> Column:
    """A half-open period; a NULL end is open."""
    return F.struct(start.alias("from"), end.alias("to"))


def period_contains(value: Column, instant: Column) -> Column:
    low, high = value.getField("from"), value.getField("to")
    return (low <= instant) & (high.isNull() | (high > instant))


def period_overlaps(a: Column, b: Column) -> Column:
    def starts_before_end(x: Column, y: Column) -> Column:
        return y.getField("to").isNull() | (x.getField("from") < y.getField("to"))

    return starts_before_end(a, b) & starts_before_end(b, a)


def years_between(later: Column, earlier: Column) -> Column:
    """Difference of calendar years, the usual rough age."""
    return F.year(later) - F.year(earlier)


def age(born: Column, as_of: Column | None = None) -> Column:
    return years_between(F.current_date() if as_of is None else as_of, born)
