"""Calendar columns derived from dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The names of the 14 alias columns the notebook adds (the first two repeat the
# year, the other twelve repeat the month; the February spelling is kept as upstream wrote it).
YEAR_ALIAS_COLUMNS = ["2023", "2024"]
MONTH_ALIAS_COLUMNS = ["January", "Feburary", "March", "April", "May", "June", "July",
                       "August", "September", "October", "November", "December"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def calendar_parts(date, prefix: str) -> dict[str, Column]:
    """``{prefix}_year``, ``{prefix}_month``, ``{prefix}_day`` of a date (P10)."""
    d = _c(date)
    return {f"{prefix}_year": F.year(d), f"{prefix}_month": F.month(d),
            f"{prefix}_day": F.dayofmonth(d)}


def month_name(date) -> Column:
    """English month name, e.g. ``January``."""
    return F.date_format(_c(date), "MMMM")


def calendar_alias_columns(date) -> dict[str, Column]:
    """The 14 alias columns of P11: each year column holds the year, each month column the month."""
    d = _c(date)
    cols = {name: F.year(d) for name in YEAR_ALIAS_COLUMNS}
    cols.update({name: F.month(d) for name in MONTH_ALIAS_COLUMNS})
    return cols


def parse_date_coerce(text) -> Column:
    """Text → date, anything unparsable → null (P15; ANSI mode stays on)."""
    return F.to_date(F.try_to_timestamp(_c(text)))


def parse_date_strict(text) -> Column:
    """Text → date; unparsable text raises under ANSI mode."""
    return F.to_date(_c(text))


MS_PER_DAY = 86_400_000
# Spark's date range (0001-01-01 .. 9999-12-31) in days from 1970-01-01.
MIN_UNIX_DAY, MAX_UNIX_DAY = -719_162, 2_932_896


def epoch_millis_to_date(col) -> Column:
    """Epoch milliseconds (number or numeric text; UTC by definition) → date; bad or out-of-range
    values → null (S3). Exact integer day arithmetic, so the session time zone plays no part."""
    ms = _c(col).try_cast("bigint")
    day = (F.try_subtract(ms, F.pmod(ms, F.lit(MS_PER_DAY))) / F.lit(MS_PER_DAY)).cast("bigint")
    return F.when(day.between(MIN_UNIX_DAY, MAX_UNIX_DAY), F.date_from_unix_date(day.cast("int")))
