"""Scans of the driver's Parquet tables.

Each reader names the columns it needs so the Parquet scan's ReadSchema holds only those
(Catalyst would prune anyway; naming them keeps the contract visible).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"]
CUSTOMER_COLS = ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"]
NATION_COLS = ["n_nationkey", "n_name"]


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders", ORDERS_COLS)


def customer(spark, sf_dir):
    return table(spark, sf_dir, "customer", CUSTOMER_COLS)


def nation(spark, sf_dir):
    return table(spark, sf_dir, "nation", NATION_COLS)


def lineitem_keys(spark, sf_dir):
    """(l_orderkey, l_linenumber): the binding for duplicates and shared purchases."""
    return table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"])


def events(spark, sf_dir):
    """Events with a real time of day (second binding of hourly / daily counts)."""
    return table(spark, sf_dir, "events", ["event_id", "ts"])
