import random

from pyspark.sql import functions as F

from ticketlens.plans import star
from ticketlens.sources.rides import rides
from tests.conftest import SF001

# The 32 station names of the upstream location table, in its id order (1..32).
STATIONS = [
    "Birmingham New Street", "Bristol Temple Meads", "Cardiff Central", "Coventry", "Crewe",
    "Didcot", "Doncaster", "Durham", "Edinburgh", "Edinburgh Waverley", "Leeds", "Leicester",
    "Liverpool Lime Street", "London Euston", "London Kings Cross", "London Paddington",
    "London St Pancras", "London Waterloo", "Manchester Piccadilly", "Nottingham", "Nuneaton",
    "Oxford", "Peterborough", "Reading", "Sheffield", "Stafford", "Swindon", "Tamworth",
    "Wakefield", "Warrington", "Wolverhampton", "York",
]


def test_dim_location_ids_follow_name_order(spark):
    rnd = random.Random(7)
    pairs = [(rnd.choice(STATIONS), rnd.choice(STATIONS)) for _ in range(400)]
    pairs += [(s, s) for s in STATIONS]  # every name at least once
    df = spark.createDataFrame(pairs, "departure_station string, arrival_destination string")
    got = [(r.station_id, r.station_name) for r in star.dim_location(df).orderBy("station_id").collect()]
    assert got == list(enumerate(STATIONS, start=1))  # the upstream table is already in name order


def test_star_round_trip_equals_flat(spark):
    r = rides(spark, SF001)
    via_star = star.star_denormalised(r)
    flat = star.flat_denormalised(r)
    cols = sorted(flat.columns)
    a = via_star.select(*cols)
    b = flat.select(*cols)
    assert a.count() == b.count() == r.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fact_keeps_rows_and_ids_are_positions(spark):
    s = star.StarA(rides(spark, SF001))
    n = s.cleaned.count()
    assert s.fact.count() == n
    ids = [r[0] for r in s.fact.select("time_id").orderBy("time_id").collect()]
    assert ids == list(range(1, n + 1))
    assert s.fact.where("time_id <> journey_id").count() == 0
    assert s.fact.where("departure_station_id IS NULL OR arrival_station_id IS NULL").count() == 0


def test_variant_b_null_safe_lookup(spark):
    rows = [("T1", 1, "2024-01-01", "10:00:00", "2024-01-02", "09:00:00", "10:00:00", None, None),
            ("T1", 2, "2024-01-01", "10:00:00", "2024-01-02", "09:00:00", "10:00:00", None, None),
            ("T2", 1, "2024-01-01", "11:00:00", "2024-01-02", "09:00:00", "10:00:00", "10:30:00", "Weather"),
            ("T3", 1, None, "11:00:00", "2024-01-03", "09:00:00", "10:00:00", None, None)]
    df = (spark.createDataFrame(rows, "transaction_id string, line_number int, p string, "
                                "time_of_purchase string, j string, departure_time string, "
                                "arrival_time string, actual_arrival_time string, reason_for_delay string")
          .withColumn("date_of_purchase", F.to_date("p")).withColumn("date_of_journey", F.to_date("j"))
          .drop("p", "j"))
    for c in ("purchase_type", "payment_method", "railcard", "ticket_class", "ticket_type",
              "journey_status"):
        df = df.withColumn(c, F.lit("x"))
    df = df.withColumn("price", F.lit(1).cast("decimal(18,2)"))
    t, j = star.dim_time_b(df), star.dim_journey_b(df)
    assert t.count() == 3 and j.count() == 3
    # nulls sort first: the null-date row gets time_id 1
    assert t.where("purchase_date IS NULL").first().time_id == 1
    assert t.where("purchase_date IS NULL").first().time_key == "NaT 11:00:00"
    f = star.fact_b(df, t, j)
    assert f.count() == 4
    assert star.fk_null_check(f).first().asDict() == {"null_time_ids": 0, "null_journey_ids": 0}
    ids = {(r.transaction_id, r.line_number): (r.time_id, r.journey_id) for r in f.collect()}
    assert ids[("T1", 1)] == ids[("T1", 2)]


def test_fact_skeleton_and_string_keys(spark):
    from ticketlens.operators.clean import notebook_clean
    r = rides(spark, SF001)
    sk = star.fact_skeleton(notebook_clean(r))
    assert sk.where("time_id IS NOT NULL OR departure_station_id IS NOT NULL").count() == 0
    s = star.StarA(r)
    f = star.cast_keys_string(s.fact, ["time_id"])
    t = star.cast_keys_string(s.time.select("time_id", "hour_of_day"), ["time_id"])
    joined = f.join(t, "time_id", "left")
    assert joined.count() == s.fact.count() and joined.where("hour_of_day IS NULL").count() == 0


def test_dim_keys_are_unique_so_left_joins_keep_fact_rows(spark):
    from ticketlens.sources.rides import ride_tickets
    r = rides(spark, SF001)
    a = star.StarA(r)
    b = star.StarB(ride_tickets(spark, SF001))
    for dim, keys in [(a.location, ["station_id"]), (a.location, ["station_name"]),
                      (a.time, ["time_id"]), (a.journey, ["journey_id"]),
                      (b.time, ["time_id"]), (b.time, star.TIME_B_COLS),
                      (b.journey, ["journey_id"]), (b.journey, star.JOURNEY_B_COLS)]:
        # groupBy treats null parts as equal, matching the <=> lookups
        assert dim.groupBy(*keys).count().where("count > 1").count() == 0, keys
    assert b.fact.count() == b.tickets.count()
    assert star.fk_null_check(b.fact).first().asDict() == {"null_time_ids": 0, "null_journey_ids": 0}
