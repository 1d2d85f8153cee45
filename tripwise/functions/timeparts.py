"""Local wall-clock parts of unix-second timestamps, independent of the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _epoch() -> Column:
    return F.make_timestamp_ntz(F.lit(1970), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def local_wall_time(seconds: Column | str, tz: str) -> Column:
    """TIMESTAMP_NTZ wall time in ``tz`` of unix ``seconds`` (DST-aware)."""
    utc_wall = F.timestamp_add("SECOND", _c(seconds), _epoch())
    if tz.upper() in ("UTC", "GMT", "Z", "+00:00"):
        return utc_wall
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall)


def hour_of_day(seconds: Column | str, tz: str) -> Column:
    """Hour 0..23 in ``tz``."""
    return F.hour(local_wall_time(seconds, tz))


def weekday(seconds: Column | str, tz: str) -> Column:
    """Weekday in ``tz`` with Monday = 0 ... Sunday = 6."""
    return F.weekday(local_wall_time(seconds, tz))


def epoch_seconds_of_ntz(ts: Column | str) -> Column:
    """Whole unix seconds of a TIMESTAMP_NTZ read as UTC wall time (floor)."""
    return F.timestamp_diff("SECOND", _epoch(), _c(ts))
