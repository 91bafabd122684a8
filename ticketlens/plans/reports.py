"""Notebook reports (A1–A15, A21–A22, T1) and the counts over relabelled rides.

Each report is a function of DataFrames; all grouping goes through the operators in
``ticketlens.operators.aggregate`` (partial aggregation before every shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.functions.calendar import month_name
from ticketlens.functions.money import money_mean, money_sum
from ticketlens.functions.timeofday import hour_of_day
from ticketlens.operators.aggregate import group_count, group_sum, having_count, label_columns, \
    pivot_labels, pivot_sum, top_k, value_counts, with_share

# The category labels that reports always show, in their order (field dictionary). Pivots
# have a column for each other label that occurs as well.
TICKET_TYPES = ["Advance", "Anytime", "Off-Peak"]
REFUND_VALUES = ["No", "Yes"]
STATUS_ROW_ORDER = ["Cancelled", "Delayed", "On Time"]
REFUND_STATUSES = ["Cancelled", "Delayed"]


def month_name_counts(rides: DataFrame) -> DataFrame:
    """A2: purchases per month name, in alphabetical name order."""
    m = rides.select(month_name("date_of_purchase").alias("month_name"))
    return group_count(m, ["month_name"], "count")


def price_totals(rides: DataFrame) -> DataFrame:
    """A3: mean, sum, min, max and non-null count of the price."""
    p = F.col("price")
    return rides.agg(money_mean("price").alias("mean_price"), money_sum("price").alias("total_price"),
                     F.min(p).cast("double").alias("min_price"),
                     F.max(p).cast("double").alias("max_price"),
                     F.count(p).alias("price_count"))


def hourly_transactions(rides: DataFrame) -> DataFrame:
    """Transactions per hour of purchase."""
    h = rides.select(hour_of_day("time_of_purchase").alias("hour"))
    return group_count(h, ["hour"], "number_of_transactions")


def hourly_spine(spark: SparkSession, hours: DataFrame) -> DataFrame:
    """All 24 hours, 0 where no transaction (``hours`` has one ``hour`` column)."""
    counts = hours.groupBy("hour").agg(F.count(F.lit(1)).alias("number_of_transactions"))
    spine = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    return (spine.join(counts, "hour", "left")
            .select("hour", F.coalesce("number_of_transactions", F.lit(0)).cast("long")
                    .alias("number_of_transactions")).orderBy("hour"))


def pivot_revenue_purchase_ticket(rides: DataFrame) -> DataFrame:
    """Revenue, purchase type × ticket type; a missing cell is null."""
    labels = pivot_labels(rides.na.drop(subset=["purchase_type"]), "ticket_type", TICKET_TYPES)
    return pivot_sum(rides, "purchase_type", "ticket_type", labels, "price")


def refund_revenue_matrix(fact: DataFrame) -> DataFrame:
    """Status ∈ {Cancelled, Delayed} × refund request revenue, missing cells 0; No and Yes always
    have a column."""
    f = fact.where(F.col("journey_status").isin(REFUND_STATUSES))
    p = pivot_sum(f, "journey_status", "refund_request", pivot_labels(f, "refund_request", REFUND_VALUES), "price")
    return p.na.fill(0.0, subset=p.columns[1:])


def refund_count_matrix(spark: SparkSession, fact: DataFrame) -> DataFrame:
    """Status × refund counts, missing cells 0, rows forced to Cancelled, Delayed, On Time
    (a status with no rows gives a null row, as a pandas reindex does)."""
    known = fact.na.drop(subset=["journey_status", "refund_request"])
    labels = pivot_labels(known, "refund_request", REFUND_VALUES)
    named = label_columns(labels, ["row_order", "journey_status"])
    counts = known.groupBy("journey_status").pivot("refund_request", labels).agg(F.count(F.lit(1)))
    counts = counts.select("journey_status", *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(n) for v, n in named.items()])
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(STATUS_ROW_ORDER)],
                                 "row_order int, journey_status string")
    return (rows.join(counts, "journey_status", "left")
            .select("row_order", "journey_status", *named.values()).orderBy("row_order"))


def share_of_counts(df: DataFrame, key: str) -> DataFrame:
    """A21 on counts: value_counts + percent of total."""
    return with_share(value_counts(df, key, "count"), "count").orderBy(F.desc("count"), key)


def share_of_revenue(df: DataFrame, key: str) -> DataFrame:
    """A21 on revenue: exact decimal sums, share from the exact total, then doubles."""
    s = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("price").alias("revenue"))
    return (with_share(s, "revenue").withColumn("revenue", F.col("revenue").cast("double"))
            .orderBy(key))


def top5_departure_stations(rides: DataFrame) -> DataFrame:
    """Five departure stations with most revenue (observed stations; ties by name)."""
    s = group_sum(rides, ["departure_station"], "price", "revenue")
    return top_k(s, [F.desc("revenue"), F.asc("departure_station")], 5)


# ------------------------------------------------------------------ counts over cleaned rides

def repeated_groups(*keys: str, limit: int | None = None):
    """Groups of more than one ticket, the largest first."""
    return lambda rides: having_count(rides, list(keys), "tickets", limit=limit)


def tickets_by_month(date_col: str):
    """Tickets per calendar month of a date, the busiest month first."""
    return lambda rides: having_count(rides.select(F.month(date_col).alias("month")), ["month"], "tickets",
                                      min_count=0)


def mean_whole_price(rides: DataFrame) -> DataFrame:
    """A4: mean of the whole-number prices."""
    return rides.agg(F.avg("price2").alias("mean_price"))


#: Registered name → report over the relabelled rides with their whole-number price.
CLEANED_REPORTS = {
    "sql_avg_price2": mean_whole_price,
    "sql_class_railcard": repeated_groups("ticket_class", "railcard"),
    "sql_group_count_payment_method": repeated_groups("payment_method"),
    "sql_group_count_purchase_type": repeated_groups("purchase_type"),
    "sql_group_count_railcard": repeated_groups("railcard"),
    "sql_group_count_ticket_class": repeated_groups("ticket_class"),
    "sql_group_count_ticket_type": repeated_groups("ticket_type"),
    "sql_month_journeys": tickets_by_month("date_of_journey"),
    "sql_month_purchases": tickets_by_month("date_of_purchase"),
    "sql_status_reason": repeated_groups("journey_status", "reason_for_delay"),
    "sql_status_refund_top3": repeated_groups("journey_status", "refund_request", limit=3),
}
