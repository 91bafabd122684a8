from pyspark.sql import Window
from pyspark.sql import functions as F

from ticketlens.operators.ids import with_contiguous_id, with_running_total


def test_contiguous_ids_with_hot_leading_key(spark):
    # a third of all rows share the leading sort key; ids must still be 1..N in key order
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(
            F.concat(F.lit("2024-02-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0")))
        .alias("d"), (F.col("id") * 7919 % 10007).alias("t"), F.col("id").alias("k"))
    ided = with_contiguous_id(df.repartition(13), ["d", "t", "k"], "rid", num_partitions=16)
    expect = df.withColumn("rid", F.row_number().over(Window.orderBy("d", "t", "k")))
    got = sorted((r.k, r.rid) for r in ided.collect())
    exp = sorted((r.k, r.rid) for r in expect.collect())
    assert got == exp
    assert sorted(r for _, r in got) == list(range(1, n + 1))


def test_running_total_over_frequency_table(spark):
    df = spark.createDataFrame([(v, c) for v, c in [(5, 2), (1, 3), (9, 1), (3, 4)]], "v int, c long")
    out = {r.v: r.before for r in with_running_total(df, ["v"], "c", "before").collect()}
    assert out == {1: 0, 3: 3, 5: 7, 9: 9}
