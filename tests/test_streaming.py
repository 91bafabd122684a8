import os
import uuid

from pyspark.sql import functions as F

from ticketlens.session import checkpoint_dir
from ticketlens.sources.rides import rides
from ticketlens.streaming import live_panels
from tests.conftest import SF001


def test_stream_totals_equal_batch_totals(spark):
    src = os.path.join(checkpoint_dir(spark), "in-" + uuid.uuid4().hex)
    r = rides(spark, SF001)
    # two arrivals of files
    r.where(F.col("transaction_id") < "T0000000700").write.parquet(src + "/a")
    r.where(F.col("transaction_id") >= "T0000000700").write.parquet(src + "/b")
    name = "sr-" + uuid.uuid4().hex
    q = live_panels.start_status_refund_panel(spark, src + "/*", name, available_now=True)
    q.awaitTermination(120)
    got = {(x.journey_status, x.refund_request): (x["count"], x.revenue)
           for x in live_panels.panel_table(spark, name).collect()}
    exp = {(x.journey_status, x.refund_request): (x.n, float(x.rev)) for x in
           live_panels.notebook_clean(r).groupBy("journey_status", "refund_request")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("rev")).collect()}
    assert got == exp
