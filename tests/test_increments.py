from pyspark.sql import functions as F

from tests.conftest import SF001
from ticketlens.plans import increments, star
from ticketlens.session import materialise, scratch_path
from ticketlens.sources.rides import ride_tickets


def test_batches_give_stable_unique_ids_and_the_lookups_of_one_load(spark):
    t = ride_tickets(spark, SF001).withColumn("departure_time", F.when(F.col("line_number") != 2, F.col("departure_time"))).cache()
    day = F.dayofyear("date_of_purchase")
    path = scratch_path(spark, "batches")
    assert increments.load_batch(spark, t.where(day <= 200), path, "one")
    before = {n: sorted(map(tuple, df.collect()), key=str) for n, df in increments.tables(spark, path).items()}
    assert increments.load_batch(spark, t.where(day > 150), path, "two")  # overlaps the first
    assert not increments.load_batch(spark, t.where(day > 150), path, "two")  # loaded already
    after = increments.tables(spark, path)
    for name, rows in before.items():  # no old row changed
        assert set(map(str, rows)) <= set(map(str, map(tuple, after[name].collect())))
    for name, key, cols in (("dim_time", "time_id", star.TIME_B_COLS), ("dim_journey", "journey_id", star.JOURNEY_B_COLS)):
        ids = sorted(r[0] for r in after[name].select(key).collect())
        assert ids == list(range(1, len(ids) + 1))
        keys = [tuple(r) for r in after[name].select(*cols).collect()]
        assert len(keys) == len(set(keys)) == star.renamed_dates(t).select(*cols).distinct().count()
    fact = after["fact"].join(after["dim_journey"].select("journey_id", *star.JOURNEY_B_COLS), "journey_id")
    got = sorted((r.transaction_id, r.line_number, str(r.journey_date), str(r.departure_time)) for r in fact.collect())
    want = [(r.transaction_id, r.line_number, str(r.date_of_journey), str(r.departure_time)) for p in (day <= 200, day > 150) for r in t.where(p).collect()]
    assert got == sorted(want)
    assert after["fact"].where("time_id is null or journey_id is null").isEmpty()


def test_an_empty_batch_adds_nothing(spark):
    t = ride_tickets(spark, SF001).limit(50)
    path = scratch_path(spark, "batches")
    increments.load_batch(spark, t.limit(0), path, "none")
    assert all(df.isEmpty() for df in increments.tables(spark, path).values())
    increments.load_batch(spark, t, path, "some")
    increments.load_batch(spark, t.limit(0), path, "none again")
    got = increments.tables(spark, path)
    assert got["fact"].count() == 50 and got["dim_time"].agg(F.min("time_id")).first()[0] == 1


def test_a_batch_streams_its_tickets_by_the_dimensions(spark, monkeypatch):
    """Tickets, the many and wide rows, are neither sorted nor copied; nulls and repeats are looked up as ever."""
    t = ride_tickets(spark, SF001).select(*star.TICKET_B_COLS).withColumn(
        "time_of_purchase", F.when(F.col("line_number") != 1, F.col("time_of_purchase")))
    table, path = materialise(t.unionByName(t.where("line_number = 2")), "tickets"), scratch_path(spark, "batches")
    plans, fact_b = [], star.fact_b
    monkeypatch.setattr(star, "fact_b", lambda *a, **k: plans.append(fact_b(*a, **k)) or plans[-1])
    labels, written = [], increments.materialise
    monkeypatch.setattr(increments, "materialise", lambda df, label: labels.append(label) or written(df, label))
    day = F.dayofyear("date_of_purchase")
    for name, part in (("one", day <= 200), ("two", day > 200)):
        assert increments.load_batch(spark, table.where(part), path, name, stored=True)
    assert "batch" not in labels
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan
    got = increments.tables(spark, path)
    fact = got["fact"].join(got["dim_time"].select("time_id", *star.TIME_B_COLS), "time_id").join(
        got["dim_journey"].select("journey_id", *star.JOURNEY_B_COLS), "journey_id").drop("time_id", "journey_id")
    want = star.renamed_dates(table)
    assert sorted(map(str, fact.select(*want.columns).collect())) == sorted(map(str, want.collect()))
