from ticketlens.operators import clean
from ticketlens.operators.profile import duplicate_count

SCHEMA = "a string, b string, c string"


def test_fills_and_fill_from_column(spark):
    df = spark.createDataFrame([("x", None, None), (None, "y", "z")],
                               "reason_for_delay string, railcard string, actual_arrival_time string")
    df = df.withColumn("arrival_time", df.reason_for_delay)
    out = clean.fill_from_column(clean.fill_const(df, {"railcard": "No Railcard"}),
                                 "actual_arrival_time", "arrival_time").collect()
    assert out[0].railcard == "No Railcard" and out[0].actual_arrival_time == "x"
    assert out[1].actual_arrival_time == "z"


def test_drops(spark):
    df = spark.createDataFrame([(None, None, None), ("1", None, None), ("1", "2", "3")], SCHEMA)
    assert clean.drop_any_null(df).count() == 1
    assert clean.drop_all_null(df).count() == 2
    assert clean.drop_null_subset(df, ["a"]).count() == 2


def test_dedup_and_duplicate_count(spark):
    df = spark.createDataFrame([("1", None, "x")] * 3 + [("2", None, "x")], SCHEMA)
    assert clean.dedup(df).count() == 2
    assert duplicate_count(df).first()[0] == 2


def test_sql_relabels_are_case_insensitive_and_keep_label_sets_apart(spark):
    df = spark.createDataFrame([("On Time", "None", "None"), ("on time", "NONE", "Adult"),
                                ("Delayed", "None", "none")],
                               "journey_status string, reason_for_delay string, railcard string")
    out = clean.relabel_railcard(clean.relabel_delay_on_time(df)).collect()
    assert [r.reason_for_delay for r in out] == ["No delay", "No delay", "None"]  # only on-time rows
    assert [r.railcard for r in out] == ["No Card", "Adult", "No Card"]


def test_notebook_clean_uses_notebook_labels(spark):
    from ticketlens.sources.rides import rides
    from tests.conftest import SF001
    c = clean.notebook_clean(rides(spark, SF001))
    labels = {r[0] for r in c.select("reason_for_delay").distinct().collect()}
    assert "No Delay" in labels and "No delay" not in labels
    assert c.where("railcard IS NULL OR actual_arrival_time IS NULL").count() == 0
