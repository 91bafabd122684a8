"""A stored cube of additive cells, from which every panel and every filter is a roll-up.

One aggregation with grouping sets turns the denormalised rides into cells. Every set holds the five
filter dimensions, and one panel's key (or none) next to them; a cell holds what adds up: rows, the
exact sum of prices, priced rows. A filter picks cells, a panel sums them: no ride is read again.

Scale: rides are dealt by the filter dimensions first (the few columns that cells are made of), so a task
combines its rides into its own share of the cells: a task's table of cells shrinks with the number of
tasks, where rides in table order would give every task nearly all cells. Adaptive execution splits what a
hot combination makes too large, and each part is combined before the next shuffle, so what moves then is
cells, whose number is bounded by the dimensions' values (months x stations x ticket types x railcards x
payments x a key's values) and not by the rides. Cells are written partitioned by set and month, so a panel
reads one set, the month filter prunes its partitions, and the other filters reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.operators.filters import PanelFilters, apply_filters
from ticketlens.plans.panels import COUNT, SUM, PanelBase, category_domains
from ticketlens.sources.publish import publish, published

FILTER_COLUMNS = ["month", "departure_station_name", "ticket_type", "railcard", "payment_method"]
#: Set name -> the columns it has besides the filters'.
SETS = {
    "filters": [],
    "hour_of_day": ["hour_of_day"],
    "purchase_date": ["purchase_date"],
    "journey_date": ["journey_date"],
    "ticket_class": ["ticket_class"],
    "reason_for_delay": ["reason_for_delay"],
    "purchase_type": ["purchase_type"],
    "status_refund": ["journey_status", "refund_request"],
}
STATES = ["n", "total", "priced"]


def cells(base: DataFrame) -> DataFrame:
    """The cells of all sets whose columns ``base`` has: ``cell_set``, the filters' columns, the sets'
    columns (null where a cell's set hasn't them), and the states."""
    filters = [c for c in FILTER_COLUMNS if c in base.columns]
    sets = {name: own for name, own in SETS.items() if all(c in base.columns for c in own)}
    columns = filters + [c for own in sets.values() for c in own]
    priced = "price" in base.columns
    price = F.col("price") if priced else F.lit(None).cast("decimal(18,2)")
    states = [F.count(F.lit(1)).alias("n"), F.sum(price).alias("total"), F.count(price).alias("priced")]
    name = F.lit("filters")
    for s, own in sets.items():
        if own:
            name = F.when(F.grouping(own[0]) == 0, s).otherwise(name)
    rides = base.select(*columns, *(["price"] if priced else []))
    dealt = rides.hint("rebalance", *filters) if filters else rides
    return (dealt
            .groupingSets([[F.col(c) for c in filters + own] for own in sets.values()], *(F.col(c) for c in columns))
            .agg(name.alias("cell_set"), *states)
            .select("cell_set", *columns, *STATES))


def build(base: DataFrame, path: str) -> None:
    """Publish the cube of ``base`` and its category domains as a new version under ``path``."""
    made = cells(base)
    parts = [c for c in ("cell_set", "month") if c in made.columns]
    publish({"cells": (made.repartition("cell_set", *[c for c in parts[1:]]), parts), "domains": (category_domains(base).coalesce(1), [])}, path,
            base.sparkSession)


def load(spark: SparkSession, path: str) -> PanelCube:
    """The newest published version."""
    tables = published(spark, path)
    return PanelCube(tables["cells"], tables["domains"])


class PanelCube(PanelBase):
    """Serves panels from cells."""

    def __init__(self, cells: DataFrame, domains: DataFrame):
        super().__init__(cells, None, domains)

    def has(self, columns: list[str]) -> bool:
        return all(c in self.base.columns for c in columns if c != "price")

    def selected(self, filters: PanelFilters | None, keys: list[str]) -> DataFrame:
        name = next(s for s, own in SETS.items() if set(keys) <= {*FILTER_COLUMNS, *own})
        return apply_filters(self.base.where(F.col("cell_set") == name), filters)

    def state(self, kind: str, value: str | None, out: str) -> Column:
        if kind == COUNT:
            return F.sum("n").alias(out)
        if kind == SUM:
            return F.sum("total").alias(out)
        return F.try_divide(F.sum("total").cast("double"), F.sum("priced").cast("double")).alias(out)


