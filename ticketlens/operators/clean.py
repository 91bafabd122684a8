"""Cleaning operators: fills, drops, relabels, deduplication and the SQL-script cleaning path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.functions.money import clean_price, price_text

# The two label sets used upstream (notebook fills vs. SQL-script updates).
NO_DELAY = "No Delay"
NO_RAILCARD = "No Railcard"
SQL_NO_DELAY = "No delay"
SQL_NO_CARD = "No Card"
SQL_NONE_TEXT = "None"


def fill_const(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """fillna with constants."""
    return df.na.fill(values)


def fill_from_column(df: DataFrame, target: str, source: str) -> DataFrame:
    """target ← source where target is null."""
    return df.withColumn(target, F.coalesce(F.col(target), F.col(source)))


def drop_any_null(df: DataFrame) -> DataFrame:
    """dropna() (F8)."""
    return df.na.drop(how="any")


def drop_null_subset(df: DataFrame, subset: list[str]) -> DataFrame:
    """dropna(subset=...)."""
    return df.na.drop(how="any", subset=subset)


def drop_all_null(df: DataFrame) -> DataFrame:
    """dropna(how='all')."""
    return df.na.drop(how="all")


def dedup(df: DataFrame) -> DataFrame:
    """drop_duplicates over all columns; nulls compare equal."""
    return df.dropDuplicates()


def notebook_clean(rides: DataFrame) -> DataFrame:
    """The notebook's cleaned table: reason → 'No Delay', railcard → 'No Railcard', missing actual
    arrival ← scheduled arrival."""
    filled = fill_const(rides, {"reason_for_delay": NO_DELAY, "railcard": NO_RAILCARD})
    return fill_from_column(filled, "actual_arrival_time", "arrival_time")


def sql_source_table(rides: DataFrame) -> DataFrame:
    """The SQL script's input table: price as ``£1,234.50`` text, missing railcard and reason as
    the text ``None`` (how the flat file holds them before cleaning)."""
    return (rides
            .withColumn("price", price_text("price"))
            .withColumn("railcard", F.coalesce("railcard", F.lit(SQL_NONE_TEXT)))
            .withColumn("reason_for_delay", F.coalesce("reason_for_delay", F.lit(SQL_NONE_TEXT))))


def relabel_delay_on_time(df: DataFrame) -> DataFrame:
    """A journey on time without a reason gets the reason 'No delay' (P8). The comparison is case-insensitive, as under MySQL's default collation."""
    cond = (F.lower("journey_status") == "on time") & (F.lower("reason_for_delay") == "none")
    return df.withColumn("reason_for_delay",
                         F.when(cond, F.lit(SQL_NO_DELAY)).otherwise(F.col("reason_for_delay")))


def relabel_railcard(df: DataFrame) -> DataFrame:
    """A missing railcard (the text 'None', in any case) is called 'No Card' (P9)."""
    return df.withColumn("railcard", F.when(F.lower("railcard") == "none", F.lit(SQL_NO_CARD))
                         .otherwise(F.col("railcard")))


def add_price2(df: DataFrame) -> DataFrame:
    """Whole-number price next to the price text."""
    return df.withColumn("price2", clean_price("price"))


def sql_cleandata(source: DataFrame) -> DataFrame:
    """The SQL script's cleaning sequence as one projection."""
    return add_price2(relabel_railcard(relabel_delay_on_time(source)))
