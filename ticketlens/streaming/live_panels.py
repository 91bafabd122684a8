"""The dashboard's status × refund panels (D12, D14) kept current while ride files arrive.

The upstream dashboard recomputes its panels from a file loaded at start-up. Here the same
cleaning and grouping run as a Structured Streaming query over a folder of flat ride files: each
micro-batch is partially aggregated, the running totals live in the state store (keyed by the two
categorical columns, so state stays a handful of rows), and every trigger publishes the panel table anew.
Checkpoint and output live in the shared checkpoint folder, so a restarted driver resumes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticketlens.operators.clean import notebook_clean
from ticketlens.session import checkpoint_dir
from ticketlens.sources.files import RIDES_SCHEMA
from ticketlens.sources.publish import drop_old, publish, published


def ride_stream(spark: SparkSession, source_dir: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Flat ride files appearing under ``source_dir`` as a stream (explicit schema)."""
    r = spark.readStream.schema(RIDES_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        return r.option("header", True).option("nullValue", "None").csv(source_dir)
    return r.parquet(source_dir)


def status_refund_totals(rides: DataFrame) -> DataFrame:
    """Running revenue and count per (journey status, refund request) on the cleaned stream."""
    c = notebook_clean(rides)
    return (c.groupBy("journey_status", "refund_request")
            .agg(F.sum("price").alias("revenue"), F.count(F.lit(1)).alias("count")))


def start_status_refund_panel(spark: SparkSession, source_dir: str, out_name: str = "status_refund",
                              fmt: str = "parquet", available_now: bool = False) -> StreamingQuery:
    """Start the stream; each trigger publishes the current totals, revenue as double, as a version under
    ``<checkpoint>/<out_name>/panel``. The last two versions stay, so that a reader of the one before isn't
    disturbed; a batch that is run again after a failure replaces its own version."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/{out_name}"

    def put(batch: DataFrame, epoch: int) -> None:
        totals = batch.withColumn("revenue", F.col("revenue").cast("double"))
        publish({"totals": (totals, [])}, f"{base}/panel", batch.sparkSession, version=f"epoch{epoch}")
        drop_old(batch.sparkSession, f"{base}/panel", keep=2)

    w = (status_refund_totals(ride_stream(spark, source_dir, fmt)).writeStream
         .outputMode("complete").option("checkpointLocation", f"{base}/_checkpoint")
         .foreachBatch(put))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def panel_table(spark: SparkSession, out_name: str = "status_refund") -> DataFrame:
    """The newest published totals."""
    return published(spark, f"{checkpoint_dir(spark).rstrip('/')}/{out_name}/panel")["totals"]
