"""File scans and sinks.

Reads always pass an explicit schema: no inference pass over the data, stable types, and the
Parquet/CSV readers can prune columns. The main storage format is Parquet; CSV is kept for the
upstream hand-off format (header row, no index column).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, IntegerType, LongType, \
    StringType, StructField, StructType

from ticketlens.functions.calendar import epoch_millis_to_date
from ticketlens.session import materialise
from ticketlens.sources.publish import publish

S = StringType()

RIDES_SCHEMA = StructType([
    StructField("transaction_id", S), StructField("date_of_purchase", DateType()),
    StructField("time_of_purchase", S), StructField("purchase_type", S),
    StructField("payment_method", S), StructField("railcard", S), StructField("ticket_class", S),
    StructField("ticket_type", S), StructField("price", DecimalType(18, 2)),
    StructField("departure_station", S), StructField("arrival_destination", S),
    StructField("date_of_journey", DateType()), StructField("departure_time", S),
    StructField("arrival_time", S), StructField("actual_arrival_time", S),
    StructField("journey_status", S), StructField("reason_for_delay", S),
    StructField("refund_request", S),
])

STAR_SCHEMAS = {
    "fact_transactions": StructType([
        StructField("transaction_id", S), StructField("purchase_type", S),
        StructField("payment_method", S), StructField("railcard", S),
        StructField("ticket_class", S), StructField("ticket_type", S),
        StructField("price", DecimalType(18, 2)), StructField("journey_status", S),
        StructField("departure_station_id", IntegerType()),
        StructField("arrival_station_id", IntegerType()), StructField("time_id", LongType()),
        StructField("journey_id", LongType()), StructField("refund_request", S)]),
    "dim_time": StructType([
        StructField("time_id", LongType()), StructField("purchase_date", DateType()),
        StructField("time_of_purchase", S), StructField("day", IntegerType()),
        StructField("month", IntegerType()), StructField("year", IntegerType()),
        StructField("time_key", S), StructField("hour_of_day", IntegerType())]),
    "dim_journey": StructType([
        StructField("journey_id", LongType()), StructField("journey_date", DateType()),
        StructField("departure_time", S), StructField("arrival_time", S),
        StructField("actual_arrival_time", S), StructField("reason_for_delay", S),
        StructField("duration_time", DoubleType()), StructField("delay_period", DoubleType()),
        StructField("journey_key", S)]),
    "dim_location": StructType([
        StructField("station_id", IntegerType()), StructField("station_name", S)]),
}


def trim_column_names(df: DataFrame) -> DataFrame:
    """Strip surrounding whitespace from every column name."""
    return df.toDF(*[c.strip() for c in df.columns])


def scan_rides_csv(spark: SparkSession, path: str, null_token: str = "None") -> DataFrame:
    """The flat ticket file (header row). ``null_token`` text reads as null (the file writes a
    missing railcard / reason as ``None``); an empty field is null as well, and so is one that can't be
    read: :func:`scan_rides_checked` tells which and keeps such rows apart."""
    return (spark.read.schema(RIDES_SCHEMA).option("header", True)
            .option("nullValue", null_token).option("mode", "PERMISSIVE").csv(path))


#: Why a row is no row of the table: its fields don't fit the header, or the named field can't be read.
MALFORMED = "malformed"


def price_of(text: Column) -> Column:
    """A price as files hold it (``12.5``, ``£1,234.50``) with its pence; anything else → null."""
    digits = F.regexp_replace(F.trim(text), "^£|(?<=[0-9]),(?=[0-9]{3})", "")
    return F.when(digits.rlike("^-?[0-9]{1,16}([.][0-9]{1,2}0*)?$"), digits.try_cast("decimal(18,2)"))


def checked_rides(raw: DataFrame) -> DataFrame:
    """The columns of a ride from texts of the same names, with ``reasons``: the fields that hold a text
    which can't be read. ``raw`` may have ``record``, the whole line of a row that doesn't fit the header."""
    read, reasons = [], []
    if "record" in raw.columns:
        reasons.append(F.when(F.col("record").isNotNull(), F.lit(MALFORMED)))
    for f in RIDES_SCHEMA.fields:
        text = F.col(f.name)
        value = text if f.dataType == S else price_of(text) if f.name == "price" else F.to_date(
            F.try_to_timestamp(F.trim(text), F.lit("yyyy-MM-dd")))
        read.append(value.alias(f.name))
        if f.dataType != S:
            reasons.append(F.when(text.isNotNull() & value.isNull(), F.lit(f.name)))
    kept = [F.col("record")] if "record" in raw.columns else []
    raws = F.struct(*[F.col(f.name) for f in RIDES_SCHEMA.fields]).alias("fields")
    return raw.select(*read, F.array_compact(F.array(*reasons)).alias("reasons"), raws, *kept)


def scan_rides_checked(spark: SparkSession, path: str, null_token: str = "None", header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1 with a reject channel: (table, rejects). Every row of the file is in one of them. A row of the
    table fits the header, and all its dates and prices could be read (prices also with a pound sign
    and thousands separators). A reject has ``reasons``, its ``fields`` as texts, and its ``record``
    where the line doesn't fit the header.

    The file is parsed once, all fields as texts, and written once with its reasons; table and rejects
    are scans of that copy."""
    schema = StructType([*(StructField(f.name, S) for f in RIDES_SCHEMA.fields), StructField("record", S)])
    raw = (spark.read.schema(schema).option("header", header).option("nullValue", null_token).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "record").csv(path))
    checked = materialise(checked_rides(raw), "checked")
    good = F.size("reasons") == 0
    return (checked.where(good).select(*RIDES_SCHEMA.names),
            checked.where(~good).select("transaction_id", "reasons", "fields", "record"))


def reject_counts(table: DataFrame, rejects: DataFrame) -> DataFrame:
    """(outcome, n): accepted rows, rejected rows, and the rejected rows of each reason."""
    accepted = table.agg(F.lit("accepted").alias("outcome"), F.count(F.lit(1)).alias("n"))
    rejected = rejects.agg(F.lit("rejected").alias("outcome"), F.count(F.lit(1)).alias("n"))
    by = rejects.select(F.explode("reasons").alias("outcome")).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    return accepted.unionByName(rejected).unionByName(by)


def ingest_rides(spark: SparkSession, path: str, out: str, null_token: str = "None") -> str:
    """Publish a file's rides, its rejects beside them, and their counts as a version under ``out``."""
    table, rejects = scan_rides_checked(spark, path, null_token)
    counts = reject_counts(table, rejects)
    return publish({"rides": (table, []), "rejects": (rejects, []), "counts": (counts, [])}, out, spark)


def scan_star(spark: SparkSession, directory: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The four star tables. If one isn't there, all four are empty frames of their schemas (the
    app's load guard), so downstream panels return empty results; any other failure is raised."""
    out = {}
    for name, schema in STAR_SCHEMAS.items():
        path = f"{directory.rstrip('/')}/{name}"
        reader = spark.read.schema(schema)
        try:
            df = reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {n: spark.createDataFrame([], s) for n, s in STAR_SCHEMAS.items()}
        out[name] = trim_column_names(df)
    return out


def with_epoch_dates(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """S3: columns holding epoch milliseconds → dates (``{source: target}``); bad values → null."""
    for src, dst in cols.items():
        df = df.withColumn(dst, epoch_millis_to_date(F.col(src)))
    return df


def scan_table_all(spark: SparkSession, name: str) -> DataFrame:
    """``SELECT *`` from a catalog table or view."""
    return spark.table(name).select("*")


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    """Write one table (overwrite). CSV gets a header row and no index column."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def write_star(tables: dict[str, DataFrame], directory: str, fmt: str = "parquet") -> None:
    """Write the star tables side by side under ``directory``."""
    for name, df in tables.items():
        write_table(df, f"{directory.rstrip('/')}/{name}", fmt)
