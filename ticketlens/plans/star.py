"""Star schema built from the flat table — both upstream variants — and its denormalisation.

Variant A (notebook, used by the dashboard): one dim_time and one dim_journey row per transaction,
ids 1..N in (purchase date, purchase time, transaction id) order; both ids equal the row's
position, so the fact carries them without a join. Stations get ids 1..K in name order.

Variant B (model-build script): dim_time / dim_journey are the *distinct* (date, time) and
(date, three times, reason) rows with ids 1..K in column order (nulls first); the fact finds its
ids by a left join on those columns with null-safe equality (the script's text keys turned missing
values into ``nan``/``NaT`` text, so missing parts matched each other).

Joins at scale: dim keys are unique (checked by construction: distinct rows, or one row per
transaction), so left joins never multiply fact rows. Fact ⋈ dim on ids is sort-merge unless AQE
measures a side under the broadcast threshold; a hot key on the fact side is split by AQE's skew
join, and the dim side of a hot key is a single row.
"""

from __future__ import annotations

import functools
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.functions.calendar import month_name
from ticketlens.functions.keys import composite_key, journey_key, time_key
from ticketlens.functions.timeofday import delay_minutes, hour_of_day, minutes_between, \
    minutes_between_wrapped
from ticketlens.operators.clean import notebook_clean
from ticketlens.operators.ids import with_contiguous_id
from ticketlens.session import materialise

ROW_ORDER = ["date_of_purchase", "time_of_purchase", "transaction_id"]


# ---------------------------------------------------------------- variant A

def with_row_id(cleaned: DataFrame) -> DataFrame:
    """K1: row_id = 1..N in ROW_ORDER (ascending, nulls first)."""
    return with_contiguous_id(cleaned, [F.asc_nulls_first(c) for c in ROW_ORDER], "row_id")


def station_union_distinct(rides: DataFrame) -> DataFrame:
    """Every station named as departure or arrival, once; one scan of the rides."""
    both = F.explode(F.array("departure_station", "arrival_destination"))
    return rides.select(both.alias("station_name")).where(F.col("station_name").isNotNull()).distinct()


def dim_location(rides: DataFrame) -> DataFrame:
    """station_id 1..K in name order."""
    names = station_union_distinct(rides)
    return with_contiguous_id(names, ["station_name"], "station_id").select(
        F.col("station_id").cast("int").alias("station_id"), "station_name")


def dim_time(ided: DataFrame) -> DataFrame:
    """dim_time, one row per transaction."""
    d = F.col("date_of_purchase")
    return ided.select(
        F.col("row_id").alias("time_id"), d.alias("purchase_date"), "time_of_purchase",
        F.dayofmonth(d).alias("day"), F.month(d).alias("month"), F.year(d).alias("year"),
        time_key(d, "time_of_purchase", "_").alias("time_key"),
        hour_of_day("time_of_purchase").alias("hour_of_day"))


def dim_journey(ided: DataFrame, wrap_midnight: bool = False) -> DataFrame:
    """dim_journey, one row per transaction; duration may be negative past midnight unless
    ``wrap_midnight`` (P17/P18); delay clipped at 0 (P19)."""
    dur = (minutes_between_wrapped if wrap_midnight else minutes_between)(
        "departure_time", "arrival_time")
    return ided.select(
        F.col("row_id").alias("journey_id"), F.col("date_of_journey").alias("journey_date"),
        "departure_time", "arrival_time", "actual_arrival_time", "reason_for_delay",
        dur.alias("duration_time"),
        delay_minutes("actual_arrival_time", "arrival_time").alias("delay_period"),
        journey_key("date_of_journey", "departure_time").alias("journey_key"))


def fact_transactions(ided: DataFrame, location: DataFrame) -> DataFrame:
    """Fact table: station names → ids by two left lookups into the role-playing location dim
    (J6); time_id = journey_id = row_id (J9, position-aligned)."""
    dep = location.select(F.col("station_name").alias("departure_station"),
                          F.col("station_id").alias("departure_station_id"))
    arr = location.select(F.col("station_name").alias("arrival_destination"),
                          F.col("station_id").alias("arrival_station_id"))
    return (ided.join(dep, "departure_station", "left").join(arr, "arrival_destination", "left")
            .select("transaction_id", "purchase_type", "payment_method", "railcard",
                    "ticket_class", "ticket_type", "price", "journey_status",
                    "departure_station_id", "arrival_station_id",
                    F.col("row_id").alias("time_id"), F.col("row_id").alias("journey_id"),
                    "refund_request"))


FK_COLUMNS = ["departure_station_id", "arrival_station_id", "time_id", "journey_id"]


def fact_skeleton(cleaned: DataFrame) -> DataFrame:
    """P2 + P3: the fact's measures under their fact names plus all-null foreign-key columns, the
    notebook's intermediate state before the lookups fill them (:func:`fact_transactions` builds
    the filled table directly)."""
    out = cleaned.select(*FACT_MEASURES)
    for c in FK_COLUMNS:
        out = out.withColumn(c, F.lit(None).cast("long" if c in ("time_id", "journey_id") else "int"))
    return out


def cast_keys_string(df: DataFrame, cols: list[str]) -> DataFrame:
    """P5: join keys as text on both sides of a join (the app reads ids as text)."""
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("string"))
    return df


FACT_MEASURES = ["transaction_id", "purchase_type", "payment_method", "railcard", "ticket_class",
                 "ticket_type", "price", "journey_status", "refund_request"]


def fact_measures(rides: DataFrame) -> DataFrame:
    """The fact table's non-key columns, row for row (the fact has one row per cleaned ticket).
    Reports that group on fact columns only read this — no ids, no range shuffle, no lookups."""
    return notebook_clean(rides).select(*FACT_MEASURES)


TIME_SOURCE = ["date_of_purchase", "time_of_purchase"]
JOURNEY_SOURCE = ["date_of_journey", "departure_time", "arrival_time", "actual_arrival_time",
                  "reason_for_delay"]


def row_ids(rides: DataFrame, *columns: str) -> DataFrame:
    """Row ids next to ``columns`` of the cleaned rides; only these and the order key are written.
    Ids follow the unique transaction id, so two calls give a ticket the same id."""
    return with_row_id(notebook_clean(rides).select(*dict.fromkeys([*ROW_ORDER, *columns])))


class StarA:
    """The four tables of variant A. Each is built when it is first asked for; those that carry row
    ids share one written frame with the columns that any of them reads."""

    def __init__(self, rides: DataFrame):
        self.rides = rides

    @cached_property
    def cleaned(self) -> DataFrame:
        return notebook_clean(self.rides)

    @cached_property
    def ided(self) -> DataFrame:
        return with_row_id(self.cleaned)

    @cached_property
    def location(self) -> DataFrame:
        return dim_location(self.rides)

    @cached_property
    def time(self) -> DataFrame:
        return dim_time(self.ided)

    @cached_property
    def journey(self) -> DataFrame:
        return dim_journey(self.ided)

    @cached_property
    def fact(self) -> DataFrame:
        return fact_transactions(self.ided, self.location)


def denormalise(fact: DataFrame, time: DataFrame, journey: DataFrame,
                location: DataFrame) -> DataFrame:
    """The dashboard's base table. Each dim is pruned to the columns the panels use before
    its join; month is recomputed from the purchase date afterwards, as upstream does."""
    t = time.select("time_id", "year", "purchase_date", "hour_of_day")
    j = journey.select("journey_id", "journey_date", "delay_period", "reason_for_delay")
    dep = location.select(F.col("station_id").alias("departure_station_id"),
                          F.col("station_name").alias("departure_station_name"))
    arr = location.select(F.col("station_id").alias("arrival_station_id"),
                          F.col("station_name").alias("arrival_station_name"))
    return (fact.join(t, "time_id", "left").join(j, "journey_id", "left")
            .join(dep, "departure_station_id", "left").join(arr, "arrival_station_id", "left")
            .withColumn("month", F.month("purchase_date"))
            .withColumn("month_name", month_name("purchase_date")))


def star_denormalised(rides: DataFrame) -> DataFrame:
    """J1–J5 over star tables as a deployment has them: stored, each written once."""
    s = StarA(rides)
    s.location = materialise(s.location, "stations")
    return denormalise(s.fact, s.time, s.journey, s.location)


def flat_denormalised(rides: DataFrame) -> DataFrame:
    """The same rows and columns as :func:`star_denormalised`, derived straight from the cleaned
    flat table: every star key is built from one flat row, so fact ⋈ dims ⋈ stations gives that row
    back (a tested identity). Panels read this form — one scan and a projection instead of an id
    range-shuffle and three sort-merge joins over the transaction table; the join path remains the
    one to use when the star tables are the stored input."""
    c = notebook_clean(rides)
    d = F.col("date_of_purchase")
    return c.select(
        "transaction_id", "purchase_type", "payment_method", "railcard", "ticket_class",
        "ticket_type", "price", "journey_status", "refund_request",
        F.year(d).alias("year"), d.alias("purchase_date"),
        hour_of_day("time_of_purchase").alias("hour_of_day"),
        F.col("date_of_journey").alias("journey_date"),
        delay_minutes("actual_arrival_time", "arrival_time").alias("delay_period"),
        "reason_for_delay",
        F.col("departure_station").alias("departure_station_name"),
        F.col("arrival_destination").alias("arrival_station_name"),
        F.month(d).alias("month"), month_name(d).alias("month_name"))


# ---------------------------------------------------------------- variant B

TIME_B_COLS = ["purchase_date", "time_of_purchase"]
JOURNEY_B_COLS = ["journey_date", "departure_time", "arrival_time", "actual_arrival_time",
                  "reason_for_delay"]


def renamed_dates(tickets: DataFrame) -> DataFrame:
    """Tickets with the date columns' names of the dimensions."""
    return (tickets.withColumnRenamed("date_of_purchase", "purchase_date")
            .withColumnRenamed("date_of_journey", "journey_date"))


def dim_time_b(tickets: DataFrame) -> DataFrame:
    """Distinct (purchase date, time) rows with calendar parts; time_id 1..K."""
    distinct = renamed_dates(tickets).select(*TIME_B_COLS).dropDuplicates()
    return described_times(with_contiguous_id(distinct, [F.asc_nulls_first(c) for c in TIME_B_COLS], "time_id"))


def described_times(ided: DataFrame) -> DataFrame:
    d = F.col("purchase_date")
    return ided.select(
        "time_id", "purchase_date", "time_of_purchase", d.alias("date"),
        F.dayofmonth(d).alias("day"), F.month(d).alias("month"), F.year(d).alias("year"),
        F.col("time_of_purchase").alias("time_of_day"),
        composite_key([d, "time_of_purchase"], ["NaT", "nan"]).alias("time_key"))


def dim_journey_b(tickets: DataFrame) -> DataFrame:
    """Distinct journey rows; journey_id 1..K."""
    distinct = renamed_dates(tickets).select(*JOURNEY_B_COLS).dropDuplicates()
    return described_journeys(with_contiguous_id(distinct, [F.asc_nulls_first(c) for c in JOURNEY_B_COLS],
                                                 "journey_id"))


def described_journeys(ided: DataFrame) -> DataFrame:
    return ided.select(
        "journey_id", *JOURNEY_B_COLS,
        composite_key(JOURNEY_B_COLS, ["NaT", "nan", "nan", "nan", "nan"]).alias("journey_key"))


def _null_safe_lookup(left: DataFrame, dim: DataFrame, cols: list[str], id_col: str, streamed: bool) -> DataFrame:
    """Left join on ``cols`` with ``<=>`` (J7/J8); the dim side has unique keys. Both sides are dealt
    by one 64-bit hash of the columns instead of all of them with their null flags, made where it is needed and not
    shuffled with the rows; that every column is the same is checked on the rows whose hashes meet (as a count, so
    that it stays a check). ``streamed``: a partition of the dim, whose rows are distinct and so evenly dealt, is
    hashed, and the many wide rows of the left side stream by; they are neither sorted nor spilled."""
    d = dim.select(id_col, *[F.col(c).alias(f"_d_{c}") for c in cols])
    d = d.hint("shuffle_hash") if streamed else d
    met = F.xxhash64(*[left[c] for c in cols]) == F.xxhash64(*[d[f"_d_{c}"] for c in cols])
    same = functools.reduce(lambda a, b: a + b, [left[c].eqNullSafe(d[f"_d_{c}"]).cast("int") for c in cols])
    return left.join(d, met & (same == len(cols)), "left").drop(*[f"_d_{c}" for c in cols])


def fact_b(tickets: DataFrame, time_b: DataFrame, journey_b: DataFrame, streamed: bool = False) -> DataFrame:
    """Fact of variant B: 8 ticket columns + time_id + journey_id; no stations, no refund."""
    raw = renamed_dates(tickets)
    with_time = _null_safe_lookup(raw, time_b, TIME_B_COLS, "time_id", streamed)
    with_both = _null_safe_lookup(with_time, journey_b, JOURNEY_B_COLS, "journey_id", streamed)
    return with_both.select("transaction_id", "line_number", "purchase_type", "payment_method",
                            "railcard", "ticket_class", "ticket_type", "price", "journey_status",
                            "time_id", "journey_id")


TICKET_B_COLS = ["transaction_id", "line_number", "purchase_type", "payment_method", "railcard",
                 "ticket_class", "ticket_type", "price", "journey_status", "date_of_purchase",
                 "time_of_purchase", "date_of_journey", *JOURNEY_B_COLS[1:]]


class StarB:
    """The three tables of variant B over one materialised input. The input feeds both distinct
    dims and the fact; writing the columns they read once to the shared checkpoint folder computes
    its upstream joins once instead of three times. Each dim is written once as well, since the fact
    looks ids up in it."""

    def __init__(self, tickets: DataFrame, materialise_input: bool = True):
        tickets = tickets.select(*TICKET_B_COLS)
        self.tickets = materialise(tickets, "tickets") if materialise_input else tickets

    @cached_property
    def time(self) -> DataFrame:
        return dim_time_b(self.tickets)

    @cached_property
    def journey(self) -> DataFrame:
        return dim_journey_b(self.tickets)

    @cached_property
    def fact(self) -> DataFrame:
        return fact_b(self.tickets, self.time, self.journey)


def fk_null_check(fact: DataFrame) -> DataFrame:
    """K3: null Time/Journey ids after the lookups (expected 0)."""
    return fact.agg(F.count_if(F.col("time_id").isNull()).alias("null_time_ids"),
                    F.count_if(F.col("journey_id").isNull()).alias("null_journey_ids"))
