"""Money and ratio expressions.

Sums of prices are exact ``decimal(18,2)``/``decimal(28,2)`` and are converted to double only at
the end; a mean is ``double(sum) / count`` — the same two IEEE operations in every engine, so
results do not depend on the order rows arrive in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_TYPE = "decimal(18,2)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def price_text(price) -> Column:
    """``£1,234.50`` style text of a price (the SQL script's input format)."""
    return F.concat(F.lit("£"), F.format_number(_c(price), 2))


def clean_price(text) -> Column:
    """Price text without currency sign and thousands separators, rounded half up to a whole number;
    text that is no price → null (P7)."""
    digits = F.regexp_replace(_c(text), "[£,]", "")
    return digits.try_cast("decimal(10,0)").cast("int")


def money_sum(price) -> Column:
    """Exact sum of a price column, returned as double."""
    return F.sum(_c(price)).cast("double")


def money_mean(price) -> Column:
    """double(exact sum) / non-null count; null for an empty group."""
    return F.try_divide(F.sum(_c(price)).cast("double"), F.count(_c(price)).cast("double"))


def round2(x) -> Column:
    """Round to 2 decimals through a decimal so tie handling is exact (HALF_UP on the shortest
    decimal form); used where two engines may differ in the last bits (std, quantiles)."""
    return F.round(_c(x).cast("decimal(38,6)"), 2).cast("double")


def percent_of(part, total) -> Column:
    """100 · part / total as double; null when the total is 0 or null (no ANSI error)."""
    return F.try_divide(F.lit(100.0) * _c(part).cast("double"), _c(total).cast("double"))
