"""Time-of-day columns.

Times are kept as ``HH:mm:ss`` text plus integer seconds of the day: Spark 4.1 has no default-on
TIME type, and integer arithmetic stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HMS = r"^([01]?[0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hms(seconds) -> Column:
    """Second of day (0..86399) → ``HH:mm:ss``."""
    s = _c(seconds)

    def two(x: Column) -> Column:
        return F.lpad(x.cast("string"), 2, "0")

    return F.concat_ws(":", two(F.floor(s / 3600)), two(F.floor((s % 3600) / 60)), two(s % 60))


def _parts(t: Column) -> list[Column]:
    return [F.split_part(t, F.lit(":"), F.lit(i)).cast("int") for i in (1, 2, 3)]


def seconds_of_day(text) -> Column:
    """``HH:mm:ss`` or ``H:mm:ss`` → seconds of the day; malformed text → null."""
    t = _c(text)
    ok = F.when(t.rlike(_HMS), t)
    h, m, s = _parts(ok)
    return h * 3600 + m * 60 + s


def seconds_of_day_strict(text) -> Column:
    """Like :func:`seconds_of_day`, but malformed text fails the query; null stays null."""
    t = _c(text)
    bad = F.raise_error(F.concat(F.lit("not a time of day: "), t)).cast("int")
    return F.when(t.isNull() | t.rlike(_HMS), seconds_of_day(t)).otherwise(bad)


def hour_of_day(text) -> Column:
    """Hour (0..23) of an ``HH:mm:ss`` or ``H:mm:ss`` value; malformed text → null."""
    t = _c(text)
    return _parts(F.when(t.rlike(_HMS), t))[0]


def minutes_between(start, end) -> Column:
    """(end − start) in minutes as double; no midnight correction, so it can be negative."""
    return (seconds_of_day(end) - seconds_of_day(start)) / F.lit(60.0)


def minutes_between_wrapped(start, end) -> Column:
    """Like :func:`minutes_between`, but an end before the start is read as the next day."""
    d = seconds_of_day(end) - seconds_of_day(start)
    return F.when(d < 0, d + 86400).otherwise(d) / F.lit(60.0)


def delay_minutes(actual, scheduled) -> Column:
    """max(0, actual − scheduled) minutes (P19); a delay past midnight clips to 0 like upstream."""
    return F.greatest(F.lit(0.0), minutes_between(scheduled, actual))
