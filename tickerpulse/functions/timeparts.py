"""Time parsing and bucketing, pinned to explicit zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import CREATED_AT_PATTERN


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_created_at(c, pattern: str = CREATED_AT_PATTERN) -> Column:
    """ISO text (``2022-11-01T03:04:05.000Z``) to a UTC wall-clock ``timestamp_ntz``.

    ``try_to_timestamp`` keeps bad text as NULL under ANSI mode. The
    result is converted to the UTC wall clock so it does not depend on
    the session time zone.
    """
    ts = F.try_to_timestamp(_col(c), F.lit(pattern))
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def bucket(c, unit: str) -> Column:
    """``date_trunc`` that keeps ``timestamp_ntz`` (Spark returns a zoned timestamp)."""
    return F.date_trunc(unit, _col(c)).cast("timestamp_ntz")


def time_parts(c) -> dict[str, Column]:
    """Year-less parts (month, day, hour) plus the date, which keeps the year."""
    t = _col(c)
    return {
        "date": F.to_date(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "hour": F.hour(t),
    }


def epoch_millis_parts(ms, zone: str = "UTC") -> dict[str, Column]:
    """Epoch milliseconds to the collector's ``date`` and ``HH:mm`` text in ``zone``."""
    local = F.from_utc_timestamp(F.timestamp_millis(_col(ms)), zone)
    return {
        "date": F.date_format(local, "yyyy-MM-dd"),
        "time": F.date_format(local, "HH:mm"),
    }


def hour_of_hhmm(date_text, hhmm) -> Column:
    """Hour of an ``HH:mm`` text on a ``yyyy-MM-dd`` date."""
    return F.hour(F.try_to_timestamp(F.concat_ws(" ", _col(date_text), _col(hhmm)),
                                     F.lit("yyyy-MM-dd HH:mm")))
