"""The flat ``rides`` table bound to the driver's order data.

The driver ships order data, not ticket sales, so every ticket field is one column expression over
``orders ⋈ customer ⋈ nation`` (see FIXTURES.md §2). The expressions only read the joined row, so
the whole binding is one narrow projection after the two joins: no extra shuffle, fully codegen'd.

Join plan at scale: ``orders ⋈ customer`` on the customer key is the one big join (customer is
~1/10 of orders); AQE keeps it sort-merge and splits a hot customer's partition if one customer
holds a large share of orders. ``nation`` has 25 rows by definition of the schema, so AQE
broadcasts it from its measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.functions.timeofday import hms
from ticketlens.sources import tables

RIDES_COLUMNS = [
    "transaction_id", "date_of_purchase", "time_of_purchase", "purchase_type", "payment_method",
    "railcard", "ticket_class", "ticket_type", "price", "departure_station",
    "arrival_destination", "date_of_journey", "departure_time", "arrival_time",
    "actual_arrival_time", "journey_status", "reason_for_delay", "refund_request",
]

RIDE_TABLES = ["orders", "customer", "nation", "lineitem"]  # what rides and their tickets are derived from

# Category labels of the ticket data (field dictionary) and the binding's code maps.
PAYMENT_BY_CODE = ["Credit Card", "Contactless", "Debit Card"]          # o_custkey % 3
RAILCARD_BY_SEGMENT = {"AUTOMOBILE": "Adult", "MACHINERY": "Senior", "HOUSEHOLD": "Disabled"}
STATUS_BY_ORDERSTATUS = {"F": "On Time", "O": "Delayed", "P": "Cancelled"}
REASON_BY_CODE = ["Weather", "Technical Issue", "Signal Failure", "Staffing", "Traffic"]  # % 5


def _case(key: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(key == F.lit(k), F.lit(v)) if out is None else out.when(key == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default)) if default is not None else out


def rides_from_tables(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                      keep_order_key: bool = False) -> DataFrame:
    """Derive ``rides`` (18 fields, see RIDES_COLUMNS) from the three source frames."""
    joined = (orders.join(customer, orders.o_custkey == customer.c_custkey)
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))
    k, u = F.col("o_orderkey"), F.col("o_custkey")
    dep = ((k * 101) % 96) * 900
    arr = (dep + 1800 + (u % 12) * 600) % 86400
    st = F.col("o_orderstatus")
    purchase_date = F.col("o_orderdate").cast("date")
    cols = {
        "transaction_id": F.concat(F.lit("T"), F.lpad(k.cast("string"), 10, "0")),
        "date_of_purchase": purchase_date,
        "time_of_purchase": hms((k * 7919) % 86400),
        "purchase_type": F.when(k % 5 < 3, "Online").otherwise("Station"),
        "payment_method": _case(u % 3, dict(enumerate(PAYMENT_BY_CODE))),
        "railcard": _case(F.col("c_mktsegment"), RAILCARD_BY_SEGMENT),
        "ticket_class": F.when(F.col("c_acctbal") > 8000, "First Class").otherwise("Standard"),
        "ticket_type": F.when(F.col("o_orderpriority") < "3", "Advance")
                        .when(F.col("o_orderpriority") < "4", "Anytime").otherwise("Off-Peak"),
        "price": F.col("o_totalprice").cast("decimal(18,2)"),
        "departure_station": F.col("n_name"),
        "arrival_destination": F.concat(F.lit("NATION_"), (k % 25).cast("string")),
        "date_of_journey": F.date_add(purchase_date, (k % 29).cast("int")),
        "departure_time": hms(dep),
        "arrival_time": hms(arr),
        "actual_arrival_time": F.when(st == "F", hms(arr))
                                .when(st == "O", hms((arr + (1 + u % 180) * 60) % 86400)),
        "journey_status": _case(st, STATUS_BY_ORDERSTATUS),
        "reason_for_delay": F.when(st != "F", _case(u % 5, dict(enumerate(REASON_BY_CODE)))),
        "refund_request": F.when((st != "F") & (u % 3 == 0), "Yes").otherwise("No"),
    }
    out = [cols[c].alias(c) for c in RIDES_COLUMNS]
    if keep_order_key:
        out.append(k.alias("order_key"))
    return joined.select(*out)


def rides(spark: SparkSession, sf_dir: str, keep_order_key: bool = False) -> DataFrame:
    return rides_from_tables(tables.orders(spark, sf_dir), tables.customer(spark, sf_dir),
                             tables.nation(spark, sf_dir), keep_order_key=keep_order_key)


def ride_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several tickets per purchase: ``rides ⋈ lineitem`` on the order key (variant-B binding,
    where purchases share (date, time) and journeys repeat)."""
    r = rides(spark, sf_dir, keep_order_key=True)
    li = tables.lineitem_keys(spark, sf_dir)
    return (r.join(li, r.order_key == li.l_orderkey)
            .select(*RIDES_COLUMNS, F.col("l_linenumber").alias("line_number")))
