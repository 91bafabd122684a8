"""Text keys the upstream model builds (kept for output parity; our joins use typed columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def journey_key(date, departure_time) -> Column:
    """``YYYY-MM-DD_HH:mm:ss`` (P20)."""
    return F.concat_ws("_", _c(date).cast("string"), _c(departure_time))


def time_key(date, time, sep: str = "_") -> Column:
    """date + sep + time (P21; variant B joins with a space)."""
    return F.concat_ws(sep, _c(date).cast("string"), _c(time))


def text_part(col, null_text: str = "nan") -> Column:
    """Text form of a key part where a missing value prints as upstream's ``nan`` / ``NaT``."""
    return F.coalesce(_c(col).cast("string"), F.lit(null_text))


def composite_key(parts: list, null_texts: list[str], sep: str = " ") -> Column:
    """Text composite key of P22 (for display / export only)."""
    return F.concat_ws(sep, *[text_part(p, n) for p, n in zip(parts, null_texts)])
