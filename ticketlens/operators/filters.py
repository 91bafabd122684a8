"""Dashboard filters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PanelFilters:
    """Up to five optional equality filters. A falsy value (None, '', 0) or ``'no-data'`` means
    "no filter"; a filter on a column the frame lacks is ignored, like upstream."""
    month: int | str | None = None
    station: str | None = None
    ticket_type: str | None = None
    railcard: str | None = None
    payment: str | None = None

    def predicates(self) -> list[tuple[str, object]]:
        out = []
        if self.month and self.month != "no-data":
            # months are compared as they are: a text, also of digits, matches no month
            out.append(("month", self.month if isinstance(self.month, int) else None))
        for col, v in (("departure_station_name", self.station), ("ticket_type", self.ticket_type),
                       ("railcard", self.railcard), ("payment_method", self.payment)):
            if v:
                out.append((col, v))
        return out


def apply_filters(df: DataFrame, filters: PanelFilters | None) -> DataFrame:
    """AND of the active filters, as plain ``where`` clauses Catalyst can push to the scan (and
    through the star joins: a filter on a left-joined dim column turns that join inner)."""
    if filters is None:
        return df
    for col, v in filters.predicates():
        if col in df.columns:
            df = df.where(F.col(col) == F.lit(v))
    return df
