import datetime as dt

import pytest
from pyspark.sql import functions as F

from ticketlens.operators.filters import PanelFilters
from ticketlens.plans import panels

# Status × refund counts printed by the revised notebook (31,653 rows).
MATRIX = [("On Time", "No", 27481), ("Delayed", "No", 1746), ("Delayed", "Yes", 546),
          ("Cancelled", "No", 1308), ("Cancelled", "Yes", 572)]


@pytest.fixture(scope="module")
def matrix_base(spark):
    parts = [spark.range(n).select(F.lit(s).alias("journey_status"), F.lit(r).alias("refund_request"))
             for s, r, n in MATRIX]
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    df = (df.withColumn("price", F.lit(10).cast("decimal(18,2)"))
          .withColumn("ticket_type", F.lit("Advance")).withColumn("month", F.lit(1)))
    return panels.PanelBase(df)


def test_matrix_counts_and_shares(matrix_base):
    c = {(r.journey_status, r.refund_request): r["count"]
         for r in panels.panel_refund_count(matrix_base).collect()}
    assert c[("On Time", "Yes")] == 0  # full domain: the unobserved pair is listed with 0
    assert sum(c.values()) == 31653 and c[("Delayed", "Yes")] == 546
    st = {r.journey_status: round(r.share_pct, 1) for r in panels.panel_status(matrix_base).collect()}
    assert st == {"On Time": 86.8, "Delayed": 7.2, "Cancelled": 5.9}
    rf = {r.refund_request: round(r.share_pct, 1) for r in panels.panel_refund_share(matrix_base).collect()}
    assert rf == {"No": 96.5, "Yes": 3.5}


@pytest.fixture(scope="module")
def small_base(spark):
    rows = [("Advance", "Adult", "Credit Card", "A", 1, 10, "No Delay", 8),
            ("Advance", "Senior", "Debit Card", "B", 2, 20, "Weather", 9),
            ("Anytime", "Adult", "Credit Card", "A", 2, 30, "Traffic", 9),
            ("Off-Peak", "No Railcard", "Contactless", "C", 3, 40, "Weather", 17)]
    df = spark.createDataFrame(rows, "ticket_type string, railcard string, payment_method string, "
                                     "departure_station_name string, month int, p int, "
                                     "reason_for_delay string, hour_of_day int")
    df = (df.withColumn("price", F.col("p").cast("decimal(18,2)")).drop("p")
          .withColumn("purchase_date", F.lit(dt.date(2024, 1, 1)))
          .withColumn("journey_date", F.lit(dt.date(2024, 1, 2))))
    stations = spark.createDataFrame([("A",), ("B",), ("C",), ("D",), ("E",), ("F",)], "station_name string")
    return panels.PanelBase(df, stations)


def test_domain_fill_under_filter(small_base):
    r = {x.ticket_type: x.revenue for x in
         panels.panel_revenue_ticket(small_base, PanelFilters(month=1)).collect()}
    assert r == {"Advance": 10.0, "Anytime": 0.0, "Off-Peak": 0.0}
    m = {x.ticket_type: x.avg_price for x in
         panels.panel_avg_price(small_base, PanelFilters(payment="Credit Card")).collect()}
    assert m == {"Advance": 10.0, "Anytime": 30.0, "Off-Peak": None}


def test_top5_with_station_filter_fills_with_zero_stations(small_base):
    out = [(r.departure_station_name, r.revenue) for r in
           panels.panel_top5_stations(small_base, PanelFilters(station="B")).collect()]
    assert out == [("B", 20.0), ("A", 0.0), ("C", 0.0), ("D", 0.0), ("E", 0.0)]


def test_empty_selection_gives_empty_panels(small_base):
    f = PanelFilters(station="nowhere")
    for name in panels.PANELS:
        assert panels.panel(small_base, name, f).count() == 0, name


def test_falsy_filters_mean_no_filter(small_base):
    full = panels.panel_railcard(small_base).collect()
    for f in (PanelFilters(month=0, station="", ticket_type=None), PanelFilters(month="no-data")):
        assert panels.panel_railcard(small_base, f).collect() == full


def test_delay_reasons_plain_column(small_base):
    out = {r.reason: r["count"] for r in panels.panel_delay_reasons(small_base).collect()}
    assert out == {"Weather": 2, "Traffic": 1}


def test_filtered_panel_equals_panel_of_filtered_base(spark, small_base):
    f = PanelFilters(railcard="Adult")
    filtered = panels.PanelBase(small_base.base.where(F.col("railcard") == "Adult"), small_base.location)
    assert panels.panel_hourly(small_base, f).collect() == panels.panel_hourly(filtered).collect()


def test_missing_column_gives_empty_frame_of_panel_schema(small_base):
    out = panels.panel_status(small_base)  # the small base has no journey_status column
    assert out.count() == 0 and out.columns == ["journey_status", "count", "share_pct"]


def test_materialised_base_prunes_month_partitions(spark):
    import os
    import uuid

    from ticketlens.plans import star
    from ticketlens.session import checkpoint_dir
    from ticketlens.sources.rides import rides
    from tests.conftest import SF001

    r = rides(spark, SF001)
    live = panels.PanelBase(star.flat_denormalised(r), star.station_union_distinct(r))
    stored = live.stored(os.path.join(checkpoint_dir(spark), "base-" + uuid.uuid4().hex))
    f = PanelFilters(month=3)
    df = panels.panel_revenue_refund(stored, f)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "(month#" in plan
    for name in panels.PANELS:
        for g in (None, f, PanelFilters(railcard="Adult", payment="Credit Card")):
            a, b = (sorted(map(str, panels.panel(x, name, g).collect())) for x in (stored, live))
            assert a == b, name


def test_hourly_panel_without_its_column_lists_24_empty_hours(small_base):
    out = panels.panel_hourly(panels.PanelBase(small_base.base.drop("hour_of_day"))).collect()
    assert sorted((r.hour_of_day, r.number_of_transactions) for r in out) == [(h, 0) for h in range(24)]


def test_a_month_that_is_no_number_selects_nothing(small_base):
    assert panels.panel_railcard(small_base, PanelFilters(month="March")).count() == 0
    assert panels.panel_hourly(small_base, PanelFilters(month="March")).count() == 0
    assert panels.panel_railcard(small_base, PanelFilters(month="3")).count() == 0  # a text is no month


NEEDS = {"panel_hourly": "hour_of_day", "panel_revenue_ticket": "price", "panel_daily_tx": "purchase_date", "panel_status": "journey_status",
         "panel_daily_revenue": "journey_date", "panel_class_revenue": "ticket_class", "panel_top5_stations": "price",
         "panel_delay_reasons": "reason_for_delay", "panel_railcard": "railcard", "panel_avg_price": "ticket_type",
         "panel_purchase_type": "purchase_type", "panel_revenue_refund": "refund_request", "panel_refund_share": "refund_request",
         "panel_refund_count": "journey_status", "panel_payment": "payment_method"}


def test_guards_of_all_panels_depend_on_the_columns_only(spark):
    from tests.conftest import SF001
    from ticketlens.plans import star
    from ticketlens.sources.rides import rides
    base = star.flat_denormalised(rides(spark, SF001)).cache()
    stations = star.station_union_distinct(rides(spark, SF001))
    for name, column in NEEDS.items():
        whole, without = (panels.panel(panels.PanelBase(b, stations), name) for b in (base, base.drop(column)))
        rows = without.collect()
        assert without.dtypes == whole.dtypes and whole.count() > 0, name
        if name == "panel_hourly":
            assert [r.number_of_transactions for r in rows] == [0] * 24
        else:
            assert not rows, name


def test_domains_of_joined_tables_come_from_the_fact(spark):
    """Categories that the fact has are found in the fact alone."""
    fact = spark.createDataFrame([(1, "On Time", "No", 5), (2, "Delayed", None, 7), (3, None, "Yes", 1), (None, "Lost", "No", 2)],
                                 "time_id long, journey_status string, refund_request string, p int").withColumn(
        "price", F.col("p").cast("decimal(18,2)")).drop("p")
    time = spark.createDataFrame([(1, 3), (2, 4), (3, 5)], "time_id long, month int")
    base = fact.join(time, "time_id", "left")
    pb, plain = panels.PanelBase(base, facts=fact), panels.PanelBase(base)
    for name in ("panel_revenue_refund", "panel_refund_count", "panel_status", "panel_payment"):
        for f in (None, PanelFilters(month=3), PanelFilters(month=5), PanelFilters(month=12)):
            got = panels.panel(pb, name, f)
            assert got.collect() == panels.panel(plain, name, f).collect()
    assert panels.panel_status(pb, PanelFilters(month=12)).isEmpty()
    listed = panels.panel_status(pb, PanelFilters(month=5)).collect()  # the only selected row has no status
    assert [(r.journey_status, r["count"]) for r in listed] == [("Delayed", 0), ("Lost", 0), ("On Time", 0)]
    for keys in (["journey_status"], ["journey_status", "refund_request"]):  # found without the joins
        assert "LeftOuter" not in pb.domain(keys)._jdf.queryExecution().optimizedPlan().toString()
