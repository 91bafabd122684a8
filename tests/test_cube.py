import threading

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from ticketlens.operators.filters import PanelFilters
from ticketlens.plans import cube, panels, star
from ticketlens.session import scratch_path
from ticketlens.sources.publish import drop_old, input_version, publish, published, versions
from ticketlens.sources.rides import rides

FILTERS = [None, PanelFilters(month=5, station="NATION_7", ticket_type="Advance", railcard="Adult", payment="Credit Card"),
           PanelFilters(railcard="Adult", payment="Credit Card"), PanelFilters(month="March")]


@pytest.fixture(scope="module")
def both(spark):
    base = star.flat_denormalised(rides(spark, SF001)).withColumn(
        "price", F.when(F.col("hour_of_day") != 7, F.col("price"))).withColumn(  # missing prices and months
        "month", F.when(F.col("hour_of_day") != 9, F.col("month"))).cache()
    path = scratch_path(spark, "cube")
    cube.build(base, path)
    return panels.PanelBase(base, star.station_union_distinct(rides(spark, SF001))), cube.load(spark, path)


def test_every_panel_of_the_cube_equals_the_rides(both):
    live, stored = both
    for name in panels.PANELS:
        for f in FILTERS:
            a, b = (sorted(map(str, panels.panel(x, name, f).collect())) for x in both)
            assert a == b, (name, f)
    assert sum(r.n for r in stored.base.where("cell_set = 'hour_of_day'").collect()) == live.base.count()


def test_a_panel_reads_its_set_and_month_only(both):
    plan = panels.panel_revenue_refund(both[1], PanelFilters(month=3, railcard="Adult"))._jdf.queryExecution().executedPlan().toString()
    assert "cell_set" in plan.split("PartitionFilters: [")[1].split("]")[0] and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(railcard,Adult)" in plan


def test_cells_are_few_where_rides_repeat(spark):
    base = star.flat_denormalised(rides(spark, SF001))
    once, many = cube.cells(base).count(), cube.cells(base.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("k")).count()
    assert once == many


def test_rides_are_dealt_by_the_filters_before_they_become_cells(both):
    plan = cube.cells(both[0].base)._jdf.queryExecution().executedPlan().toString().split("Expand [")[1]
    dealt = plan.split("hashpartitioning(")[1].split("REBALANCE_PARTITIONS_BY_COL")[0]
    assert all(f"{c}#" in dealt for c in cube.FILTER_COLUMNS)
    bare = both[0].base.drop(*cube.FILTER_COLUMNS)
    assert cube.cells(bare).where("cell_set = 'ticket_class'").agg(F.sum("n")).first()[0] == bare.count()


def test_cube_of_a_base_without_columns(both):
    base = both[0].base.drop("hour_of_day", "price", "railcard")
    lean = panels.PanelBase(base, both[0].location)
    made = cube.PanelCube(cube.cells(base), panels.category_domains(base))
    assert made.base.columns[0] == "cell_set" and "hour_of_day" not in made.base.columns
    for name in ("panel_status", "panel_daily_tx", "panel_payment", "panel_hourly", "panel_railcard"):
        assert sorted(map(str, panels.panel(made, name).collect())) == sorted(map(str, panels.panel(lean, name).collect()))


def test_readers_meet_whole_versions_only(spark):
    path = scratch_path(spark, "versions")
    with pytest.raises(FileNotFoundError):
        published(spark, path)

    def put(k):
        return publish({"a": (spark.range(k).withColumn("k", F.lit(k)), ["k"]), "b": (spark.range(k), [])}, path, spark)

    put(10)
    before = published(spark, path)
    seen, errors = [], []

    def read():
        try:
            for _ in range(8):
                t = published(spark, path)
                seen.append((t["a"].count(), t["b"].count()))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    put(20)
    last = put(30)
    reader.join()
    assert not errors and all(a == b and a in (10, 20, 30) for a, b in seen)
    assert before["a"].count() == 10  # a reader goes on with the files it has
    assert published(spark, path)["a"].count() == 30 and versions(spark, path)[-1] == last and len(versions(spark, path)) == 3
    assert len(drop_old(spark, path, keep=1)) == 2 and versions(spark, path) == [last] and published(spark, path)["b"].count() == 30


def test_a_version_that_was_not_finished_is_not_read(spark):
    path = scratch_path(spark, "versions")
    publish({"a": (spark.range(3), [])}, path, spark)
    with pytest.raises(Exception):
        publish({"a": (spark.range(5), []), "b": (spark.range(5).select(F.raise_error(F.lit("no"))), [])}, path, spark)
    assert published(spark, path)["a"].count() == 3 and len(versions(spark, path)) == 1


def test_changed_input_is_noticed(spark):
    path = scratch_path(spark, "input")
    spark.range(3).write.parquet(path)
    first = input_version(spark, [path])
    assert first == input_version(spark, [path]) != input_version(spark, [path, path + "-none"])
    spark.range(4).write.mode("overwrite").parquet(path)
    assert input_version(spark, [path]) != first
