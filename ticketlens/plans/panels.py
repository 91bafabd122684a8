"""The 15 dashboard panels (D1–D15) over the denormalised star, with the five filters.

Semantics kept from the dashboard:
* categorical keys (purchase type, payment, railcard, class, ticket type, status, refund, and the
  station names of the location dim) group with their *full* value domain — taken from the
  unfiltered base — so a filtered panel still lists every category, with 0 (sums, counts) or null
  (means) for the missing ones;
* hour, dates and delay reason are plain columns: only observed groups;
* an empty selection yields an empty panel (the app shows "No Data Available").

Plan shape: the base is stored once, partitioned by month, and so are the category domains. A panel
prunes the base by its filters (partitions by month, row groups by the others), aggregates what is
left with a map-side partial step, and joins the few groups to the stored domain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, IntegerType, LongType, StringType, \
    StructField, StructType

from ticketlens.functions.money import money_mean, percent_of
from ticketlens.operators.aggregate import category_domain, domain_product
from ticketlens.operators.filters import PanelFilters, apply_filters

SUM = "sum"
COUNT = "count"
MEAN = "mean"

#: Categorical columns of the base; their values, and the stations', are stored as domains.
CATEGORIES = ["purchase_type", "payment_method", "railcard", "ticket_class", "ticket_type",
              "journey_status", "refund_request"]
STATION = "departure_station_name"
ARRIVAL = "arrival_station_name"


def category_domains(base: DataFrame) -> DataFrame:
    """(column_name, value): the distinct values of every categorical column, of the stations named
    on either side, and of the month, from one scan of the base."""
    pairs = [(c, c) for c in CATEGORIES + ["month"]] + [(STATION, STATION), (STATION, ARRIVAL)]
    parts = [F.struct(F.lit(name).alias("column_name"), F.col(c).cast("string").alias("value"))
             for name, c in pairs if c in base.columns]
    return base.select(F.inline(F.array(*parts))).where(F.col("value").isNotNull()).distinct()


class PanelBase:
    """The denormalised base with the category domains of its unfiltered rows: stored ones
    (:meth:`stored`), else the distinct values of the base and the given stations. ``facts``: the table
    that the base was joined from by left lookups, if so; the categories it has are found there, without
    the joins, which neither lose nor change a row's own columns."""

    def __init__(self, base: DataFrame, location: DataFrame | None = None,
                 domains: DataFrame | None = None, facts: DataFrame | None = None):
        self.base = base
        self.location = location
        self.domains = domains
        self.facts = facts

    def domain(self, keys: list[str]) -> DataFrame:
        if self.domains is not None:
            mine = self.domains.where(F.col("column_name").isin(*keys))
            if len(keys) == 1:
                return mine.select(F.col("value").alias(keys[0]))
            return domain_product(mine.select(*[
                F.when(F.col("column_name") == k, F.col("value")).alias(k) for k in keys]), keys)
        if keys == [STATION] and self.location is not None:
            return self.location.select(F.col("station_name").alias(STATION))
        held = self.facts if self.facts is not None and set(keys) <= set(self.facts.columns) else self.base
        if len(keys) == 1:
            return category_domain(held, keys[0])
        return domain_product(held, keys)

    def has(self, columns: list[str]) -> bool:
        return all(c in self.base.columns for c in columns)

    def selected(self, filters: PanelFilters | None, keys: list[str]) -> DataFrame:
        """What a panel over ``keys`` aggregates."""
        return apply_filters(self.base, filters)

    def state(self, kind: str, value: str | None, out: str) -> Column:
        """The aggregate over :meth:`selected` rows that a panel shows."""
        return _agg_expr(kind, value, out)

    def stored(self, path: str, partition_by: tuple[str, ...] = ("month",)) -> "PanelBase":
        """Write the base once as Parquet partitioned by ``partition_by`` (S4), and its domains from
        that copy, and serve panels from them: the month filter prunes partitions, the other filters
        reach the scan, and every panel reads only the columns it aggregates."""
        spark = self.base.sparkSession
        self.base.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/base")
        base = spark.read.parquet(f"{path}/base")
        return self.with_domains(base, f"{path}/domains")

    @staticmethod
    def with_domains(base: DataFrame, path: str) -> "PanelBase":
        category_domains(base).coalesce(1).write.mode("overwrite").parquet(path)  # a row per category
        return PanelBase(base, None, base.sparkSession.read.parquet(path))


def _guard(pb: PanelBase, needed: list[str], out_fields: list[tuple[str, DataType]]):
    """a panel whose source column is missing is an empty frame of the panel's schema."""
    if pb.has(needed):
        return None
    schema = StructType([StructField(n, t) for n, t in out_fields])
    return pb.base.sparkSession.createDataFrame([], schema)


def _out_type(kind: str) -> DataType:
    return LongType() if kind == COUNT else DoubleType()


def _agg_expr(kind: str, value: str | None, out: str):
    if kind == COUNT:
        return F.count(F.lit(1)).alias(out)
    if kind == SUM:
        return F.sum(F.col(value)).alias(out)
    return money_mean(value).alias(out)


def full_domain_group(pb: PanelBase, filters: PanelFilters | None, keys: list[str], kind: str,
                      value: str | None, out: str) -> DataFrame:
    """groupby(keys, observed=False) on the filtered base (A12): every category of the domain, with
    what the selection has of it; no rows where the selection is empty."""
    empty = _guard(pb, keys + ([value] if value else []),
                   [(k, StringType()) for k in keys] + [(out, _out_type(kind))])
    if empty is not None:
        return empty
    f = pb.selected(filters, keys)
    groups = f.groupBy(*keys).agg(pb.state(kind, value, out))
    j = pb.domain(keys).join(groups, keys, "left").where(f.select(F.lit(1)).exists())
    if kind == SUM:  # stays an exact decimal until the panel's last step (see _money)
        j = j.withColumn(out, F.coalesce(F.col(out), F.lit(0).cast("decimal(28,2)")))
    elif kind == COUNT:
        j = j.withColumn(out, F.coalesce(F.col(out), F.lit(0)).cast("long"))
    return j


def observed_group(pb: PanelBase, filters: PanelFilters | None, key: str, kind: str,
                   value: str | None, out: str) -> DataFrame:
    """groupby on a non-categorical key: observed, non-null groups only."""
    if not pb.has([key, *([value] if value else [])]):
        kt = IntegerType() if key == "hour_of_day" else DateType()
        return _guard(pb, [key] + ([value] if value else []), [(key, kt), (out, _out_type(kind))])
    f = pb.selected(filters, [key]).where(F.col(key).isNotNull())
    r = f.groupBy(key).agg(pb.state(kind, value, out))
    if kind == SUM:
        r = r.withColumn(out, F.col(out).cast("double"))
    return r.orderBy(key)


def _share(df: DataFrame, value: str) -> DataFrame:
    """Share of the panel total; the total of an exact decimal column stays exact."""
    total = F.sum(F.col(value)).over(Window.partitionBy())
    return df.withColumn("share_pct", percent_of(F.col(value), total))


def _money(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.col(col).cast("double"))


def hours_without_data(spark: SparkSession) -> DataFrame:
    return spark.range(24).select(F.col("id").cast("int").alias("hour_of_day"),
                                  F.lit(0).cast("long").alias("number_of_transactions"))


# ------------------------------------------------------------------ panels

def panel_hourly(pb, filters=None):
    """Transactions by hour of purchase; without an hour column all 24 hours with none."""
    if not pb.has(["hour_of_day"]):
        return hours_without_data(pb.base.sparkSession)
    return observed_group(pb, filters, "hour_of_day", COUNT, None, "number_of_transactions")


def panel_revenue_ticket(pb, filters=None):
    """Revenue by ticket type (full domain)."""
    r = full_domain_group(pb, filters, ["ticket_type"], SUM, "price", "revenue")
    return _money(r, "revenue").orderBy("ticket_type")


def panel_daily_tx(pb, filters=None):
    """D3: transactions per purchase date."""
    return observed_group(pb, filters, "purchase_date", COUNT, None, "number_of_transactions")


def panel_status(pb, filters=None):
    """Journey status counts (full domain) with shares."""
    r = full_domain_group(pb, filters, ["journey_status"], COUNT, None, "count")
    return _share(r, "count").orderBy(F.desc("count"), "journey_status")


def panel_daily_revenue(pb, filters=None):
    """Revenue per journey date."""
    return observed_group(pb, filters, "journey_date", SUM, "price", "daily_revenue")


def panel_class_revenue(pb, filters=None):
    """Revenue by ticket class (full domain) with shares."""
    r = full_domain_group(pb, filters, ["ticket_class"], SUM, "price", "revenue")
    return _money(_share(r, "revenue"), "revenue").orderBy("ticket_class")


def panel_top5_stations(pb, filters=None):
    """The five departure stations with most revenue; zero-revenue stations of the location
    dim fill the list (ties: name ascending)."""
    r = _money(full_domain_group(pb, filters, ["departure_station_name"], SUM, "price",
                                 "revenue"), "revenue")
    return r.orderBy(F.desc("revenue"), F.asc("departure_station_name")).limit(5)


def panel_delay_reasons(pb, filters=None):
    """Counts of delay reasons other than 'No Delay' (plain column: observed only)."""
    empty = _guard(pb, ["reason_for_delay"], [("reason", StringType()), ("count", LongType())])
    if empty is not None:
        return empty
    f = pb.selected(filters, ["reason_for_delay"]).where(F.col("reason_for_delay") != "No Delay")
    return (f.groupBy(F.col("reason_for_delay").alias("reason"))
            .agg(pb.state(COUNT, None, "count")).orderBy(F.desc("count"), "reason"))


def panel_railcard(pb, filters=None):
    """Railcard usage (full domain)."""
    r = full_domain_group(pb, filters, ["railcard"], COUNT, None, "number_of_transactions")
    return r.select(F.col("railcard").alias("railcard_type"), "number_of_transactions") \
        .orderBy(F.desc("number_of_transactions"), "railcard_type")


def panel_avg_price(pb, filters=None):
    """Mean price by ticket type (full domain; empty category → null)."""
    return full_domain_group(pb, filters, ["ticket_type"], MEAN, "price", "avg_price") \
        .orderBy("ticket_type")


def panel_purchase_type(pb, filters=None):
    """Purchase type counts (full domain) with shares."""
    r = full_domain_group(pb, filters, ["purchase_type"], COUNT, None, "count")
    return _share(r, "count").orderBy(F.desc("count"), "purchase_type")


def panel_revenue_refund(pb, filters=None):
    """Revenue by journey status × refund request (all domain pairs)."""
    r = full_domain_group(pb, filters, ["journey_status", "refund_request"], SUM, "price",
                          "revenue")
    return _money(r, "revenue").orderBy("journey_status", "refund_request")


def panel_refund_share(pb, filters=None):
    """Refund request counts (full domain) with shares."""
    r = full_domain_group(pb, filters, ["refund_request"], COUNT, None, "count")
    return _share(r, "count").orderBy(F.desc("count"), "refund_request")


def panel_refund_count(pb, filters=None):
    """Counts by journey status × refund request (all domain pairs)."""
    return full_domain_group(pb, filters, ["journey_status", "refund_request"], COUNT, None,
                             "count").orderBy("journey_status", "refund_request")


def panel_payment(pb, filters=None):
    """Payment method counts (full domain) with shares."""
    r = full_domain_group(pb, filters, ["payment_method"], COUNT, None, "count")
    return _share(r, "count").orderBy(F.desc("count"), "payment_method")


PANELS = {
    "panel_hourly": panel_hourly,
    "panel_revenue_ticket": panel_revenue_ticket,
    "panel_daily_tx": panel_daily_tx,
    "panel_status": panel_status,
    "panel_daily_revenue": panel_daily_revenue,
    "panel_class_revenue": panel_class_revenue,
    "panel_top5_stations": panel_top5_stations,
    "panel_delay_reasons": panel_delay_reasons,
    "panel_railcard": panel_railcard,
    "panel_avg_price": panel_avg_price,
    "panel_purchase_type": panel_purchase_type,
    "panel_revenue_refund": panel_revenue_refund,
    "panel_refund_share": panel_refund_share,
    "panel_refund_count": panel_refund_count,
    "panel_payment": panel_payment,
}


def panel(pb: PanelBase, name: str, filters: PanelFilters | None = None) -> DataFrame:
    """The app's callback re-aimed: a panel name + filters → its (small) result frame."""
    return PANELS[name](pb, filters)
