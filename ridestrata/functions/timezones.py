"""Wall-clock and instant conversions.

A naive wall clock is TIMESTAMP_NTZ, an instant is TIMESTAMP. Every expression
here gives the same answer under any spark.sql.session.timeZone.
"""

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_TZ = "America/New_York"

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def naive(text: Column) -> Column:
    """Parse naive text, fractional seconds allowed; malformed text is an error."""
    return text.cast("timestamp_ntz")


def micros_between(start: Column, end: Column) -> Column:
    """Whole microseconds from one wall clock to another."""
    return F.call_function("div", end - start, F.expr("INTERVAL '0.000001' SECOND"))


def utc_naive(instant: Column) -> Column:
    """The UTC wall clock of an instant."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(_EPOCH))


def instant_of_utc(wall: Column) -> Column:
    return F.timestamp_micros(micros_between(F.expr(_EPOCH), wall))


def wall_to_instant(wall: Column, tz: str = LOCAL_TZ, overlap_minutes: int = 60) -> Column:
    """The instant a local wall clock shows.

    In the hour that is repeated when clocks go back, the later (standard time)
    instant is meant, whereas Spark's own conversion takes the earlier one; a
    wall clock inside the spring gap is read with the offset before the gap.

    ``to_utc_timestamp`` shifts its argument by the zone's offset only, so it is
    given the wall clock as if that were UTC. (``convert_timezone`` looks the
    zone up for every row and takes ten times as long.)
    """
    shown = instant_of_utc(wall)
    first = F.to_utc_timestamp(shown, tz)
    later = F.unix_micros(first) + overlap_minutes * 60_000_000
    second = F.timestamp_micros(later)
    repeated = F.from_utc_timestamp(second, tz) == shown
    return F.when(repeated, second).otherwise(first)


def instant_to_wall(instant: Column, tz: str = LOCAL_TZ) -> Column:
    return utc_naive(F.from_utc_timestamp(instant, tz))


def local_date(instant: Column, tz: str = LOCAL_TZ) -> Column:
    return F.to_date(instant_to_wall(instant, tz))


def local_hour(instant: Column, tz: str = LOCAL_TZ) -> Column:
    return F.hour(instant_to_wall(instant, tz))


def _midnight(day: date, tz: str) -> tuple[datetime, bool]:
    """First instant of a local day, and whether its midnight happens only once."""
    wall = datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(tz))
    once = wall.utcoffset() == wall.replace(fold=1).utcoffset()
    return wall.astimezone(timezone.utc), once


def in_local_dates(
    instant: Column, start: date | None, end: date | None, tz: str = LOCAL_TZ
) -> Column:
    """Inclusive local-date range; an open bound is None.

    The bounds are written as instants on the bare column, so they reach the
    Parquet scan as pushed filters. Where a bound's midnight is ambiguous the
    exact date comparison is kept as well.
    """
    keep = F.lit(True)
    if start is not None:
        first, once = _midnight(start, tz)
        keep = keep & (instant >= F.lit(first))
        if not once:
            keep = keep & (local_date(instant, tz) >= F.lit(start))
    if end is not None:
        after, once = _midnight(end + timedelta(days=1), tz)
        if once:
            keep = keep & (instant < F.lit(after))
        else:
            keep = keep & (instant < F.lit(after + timedelta(days=1)))
            keep = keep & (local_date(instant, tz) <= F.lit(end))
    return keep
