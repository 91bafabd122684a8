"""Variant B of the star kept up batch by batch.

A batch of tickets brings new times and journeys, known ones, or both. New rows of a dimension are those
that are in no earlier batch (one grouping of the old and the new keys, nulls being values); they get ids from the stored high-water mark on,
in their own order, and no id that was given out ever changes. The batch's facts look their ids up in the known
and the new rows together. Each batch is published as one version that holds its new dimension rows
and its facts, so the tables are the versions' parts side by side and nothing old is written again; a
batch that was loaded already, or whose writer died half-way, can be loaded again.

Scale: a batch shuffles its own tickets and the dimensions' key columns, never old facts. The mark is one number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.operators.ids import with_contiguous_id
from ticketlens.plans import star
from ticketlens.session import materialise
from ticketlens.sources.publish import publish, published_parts, versions


def new_rows(known: DataFrame | None, rows: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """The distinct ``keys`` of ``rows`` that ``known`` hasn't, with ids that continue those of ``known``.
    Nulls are values: two rows with a null in one place are the same row."""
    found, mark = rows.select(*keys), 0
    if known is None:
        found = found.dropDuplicates()
    else:  # one aggregate over both: what it moves are distinct keys, each once
        both = found.withColumn("_held", F.lit(0)).unionByName(known.select(*keys, F.lit(1).alias("_held")))
        found = both.groupBy(*keys).agg(F.max("_held").alias("_held")).where("_held = 0").drop("_held")
        mark = known.agg(F.max(id_col)).first()[0] or 0
    ided = with_contiguous_id(found, [F.asc_nulls_first(c) for c in keys], id_col)
    return ided.withColumn(id_col, F.col(id_col) + F.lit(mark).cast("long"))


def load_batch(spark: SparkSession, tickets: DataFrame, path: str, batch: str, stored: bool = False) -> bool:
    """Publish a batch under ``path``. False if that batch is there already. ``stored``: the tickets are rows
    of a written table, which are read again where they are needed; others are written once first."""
    if batch in versions(spark, path):
        return False
    tickets = tickets.select(*star.TICKET_B_COLS)
    tickets = tickets if stored else materialise(tickets, "batch")
    raw = star.renamed_dates(tickets)
    known = {name: published_parts(spark, path, name) for name in ("dim_time", "dim_journey")}
    added = {"dim_time": star.described_times(new_rows(known["dim_time"], raw, star.TIME_B_COLS, "time_id")),
             "dim_journey": star.described_journeys(new_rows(known["dim_journey"], raw, star.JOURNEY_B_COLS, "journey_id"))}
    added = {name: materialise(df, name) for name, df in added.items()}
    whole = {name: df if known[name] is None else known[name].unionByName(df) for name, df in added.items()}
    fact = star.fact_b(tickets, whole["dim_time"], whole["dim_journey"], streamed=True)
    publish({**{name: (df, []) for name, df in added.items()}, "fact": (fact, [])}, path, spark, version=batch)
    return True


def tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The star of all batches so far."""
    return {name: published_parts(spark, path, name) for name in ("dim_time", "dim_journey", "fact")}
