from pyspark.sql import functions as F

from ticketlens.operators.aggregate import having_count, pivot_sum, value_counts
from ticketlens.plans import reports


def _fact(spark, rows):
    return spark.createDataFrame(rows, "journey_status string, refund_request string, p int") \
        .withColumn("price", F.col("p").cast("decimal(18,2)")).drop("p")


def test_refund_count_matrix_forces_row_order(spark):
    f = _fact(spark, [("Delayed", "Yes", 1), ("On Time", "No", 2), ("On Time", "No", 3)])
    out = [(r.journey_status, r.no, r.yes) for r in reports.refund_count_matrix(spark, f).collect()]
    assert out == [("Cancelled", None, None), ("Delayed", 0, 1), ("On Time", 2, 0)]


def test_refund_revenue_matrix_fills_zero(spark):
    f = _fact(spark, [("Delayed", "Yes", 5), ("Cancelled", "No", 7), ("On Time", "No", 9)])
    out = {r.journey_status: (r.no, r.yes) for r in reports.refund_revenue_matrix(f).collect()}
    assert out == {"Delayed": (0.0, 5.0), "Cancelled": (7.0, 0.0)}


def test_pivot_missing_cell_is_null(spark):
    df = spark.createDataFrame([("Online", "Advance", 1), ("Station", "Anytime", 2)],
                               "purchase_type string, ticket_type string, p int") \
        .withColumn("price", F.col("p").cast("decimal(18,2)"))
    out = {r.purchase_type: (r.advance, r.anytime, r.off_peak)
           for r in reports.pivot_revenue_purchase_ticket(df).collect()}
    assert out == {"Online": (1.0, None, None), "Station": (None, 2.0, None)}
    assert pivot_sum(df, "purchase_type", "ticket_type", ["Advance"], "price").columns == \
        ["purchase_type", "advance"]


def test_value_counts_drop_nulls_and_order(spark):
    df = spark.createDataFrame([("x",), ("y",), ("y",), (None,), ("z",)], "c string")
    assert [(r.c, r["count"]) for r in value_counts(df, "c").collect()] == [("y", 2), ("x", 1), ("z", 1)]


def test_having_keeps_null_group_and_limits_deterministically(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("a",), ("b",), ("b",), ("c",)], "k string")
    out = [(r.k, r.number_) for r in having_count(df, ["k"], "number_", limit=2).collect()]
    assert out == [(None, 2), ("a", 2)]


def test_sql_script_reports_run_on_cleaned_table(spark):
    from ticketlens.operators import clean
    from ticketlens.sources.rides import rides
    from tests.conftest import SF001
    cd = clean.sql_cleandata(clean.sql_source_table(rides(spark, SF001)))
    for report in reports.CLEANED_REPORTS.values():
        assert report(cd).count() > 0
    top = reports.CLEANED_REPORTS["sql_status_refund_top3"](cd).collect()
    assert len(top) == 3 and [r.tickets for r in top] == sorted((r.tickets for r in top), reverse=True)
    rail = {r.railcard for r in reports.CLEANED_REPORTS["sql_group_count_railcard"](cd).collect()}
    assert "No Card" in rail and "None" not in rail
    months = reports.CLEANED_REPORTS["sql_month_journeys"](cd).collect()
    assert sum(r.tickets for r in months) == cd.count()


def test_pivots_show_labels_they_do_not_know(spark):
    import pytest

    from ticketlens.operators.aggregate import label_columns, pivot_labels
    rows = [("Online", "Advance", 1), ("Online", "Super Off-Peak", 5), ("Station", "Off Peak", 2), ("Station", "Off-Peak", 3),
            ("Station", "", 7), (None, "Lost", 1), ("Online", None, 9)]
    df = spark.createDataFrame(rows, "purchase_type string, ticket_type string, p int").withColumn("price", F.col("p").cast("decimal(18,2)"))
    out = reports.pivot_revenue_purchase_ticket(df)
    assert out.columns == ["purchase_type", "advance", "anytime", "off_peak", "blank", "off_peak_2", "super_off_peak"]
    got = {r.purchase_type: tuple(r)[1:] for r in out.collect()}
    assert got == {"Online": (1.0, None, None, None, None, 5.0), "Station": (None, None, 3.0, 7.0, 2.0, None)}
    assert sum(x for r in got.values() for x in r if x) == 18  # all rows that have both keys
    f = _fact(spark, [("Delayed", "Maybe", 5), ("Cancelled", "No", 7), ("On Time", "Maybe", 9), ("Lost", "No", 1)])
    assert {r.journey_status: (r.no, r.yes, r.maybe) for r in reports.refund_revenue_matrix(f).collect()} == \
        {"Delayed": (0.0, 0.0, 5.0), "Cancelled": (7.0, 0.0, 0.0)}
    counts = [(r.journey_status, r.no, r.yes, r.maybe) for r in reports.refund_count_matrix(spark, f).collect()]
    assert counts == [("Cancelled", 1, 0, 0), ("Delayed", 0, 0, 1), ("On Time", 0, 0, 1)]
    many = spark.range(101).select(F.col("id").cast("string").alias("k"))
    assert len(pivot_labels(many.limit(100), "k")) == 100 and pivot_labels(many.limit(0), "k") == []
    with pytest.raises(ValueError, match="more than 100 labels"):
        pivot_labels(many, "k")
    assert pivot_sum(df.limit(0), "purchase_type", "ticket_type", [], "price").columns == ["purchase_type"]
    assert label_columns(["a", "A", "a 2"], ["a"]) == {"a": "a_2", "A": "a_3", "a 2": "a_2_2"}
