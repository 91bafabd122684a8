import os
import uuid

from pyspark.sql import functions as F

from ticketlens.session import checkpoint_dir
from ticketlens.sources import files
from ticketlens.sources.rides import RIDES_COLUMNS, rides
from tests.conftest import SF001


def _dir(spark):
    return os.path.join(checkpoint_dir(spark), "t-" + uuid.uuid4().hex)


def test_csv_round_trip_keeps_values_and_nulls(spark):
    r = rides(spark, SF001)
    path = _dir(spark)
    r.write.option("header", True).option("nullValue", "None").csv(path)
    back = files.scan_rides_csv(spark, path)
    assert back.columns == RIDES_COLUMNS
    assert back.exceptAll(r).count() == 0 and r.exceptAll(back).count() == 0


def test_scan_star_missing_files_give_empty_frames(spark):
    star = files.scan_star(spark, _dir(spark))
    assert set(star) == set(files.STAR_SCHEMAS)
    for name, df in star.items():
        assert df.count() == 0 and df.schema == files.STAR_SCHEMAS[name]


def test_scan_star_is_empty_as_a_whole_and_raises_other_failures(spark):
    import pytest
    from ticketlens.plans.star import StarA
    s = StarA(rides(spark, SF001))
    d = _dir(spark)
    files.write_star({"dim_location": s.location}, d)  # one of four tables
    assert all(df.count() == 0 for df in files.scan_star(spark, d).values())
    with pytest.raises(Exception):
        files.scan_star(spark, "nosuchscheme://x/y")


def test_write_and_scan_star(spark):
    from ticketlens.plans.star import StarA
    s = StarA(rides(spark, SF001))
    d = _dir(spark)
    files.write_star({"fact_transactions": s.fact, "dim_time": s.time, "dim_journey": s.journey,
                      "dim_location": s.location}, d)
    back = files.scan_star(spark, d)
    assert back["fact_transactions"].count() == s.fact.count()
    assert back["dim_location"].count() == s.location.count()


def test_trim_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "` a ` int, `b  ` int")
    assert files.trim_column_names(df).columns == ["a", "b"]


def test_epoch_dates(spark):
    df = spark.createDataFrame([("1704067200000",), ("x",), ("1704067199999",), ("-1",),
                                ("-86400000",), ("9223372036854775807",), ("-9223372036854775808",),
                                ("12.5",)], "ms string")
    out = [str(r.d) for r in files.with_epoch_dates(df, {"ms": "d"}).collect()]
    assert out == ["2024-01-01", "None", "2023-12-31", "1969-12-31", "1969-12-31", "None", "None",
                   "None"]
    tz = spark.conf.get("spark.sql.session.timeZone")
    try:  # day arithmetic: the session time zone does not move the date
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert str(files.with_epoch_dates(df.limit(1), {"ms": "d"}).first().d) == "2024-01-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", tz)


def test_scan_table_all(spark):
    spark.range(3).createOrReplaceTempView("t_scan_all")
    assert files.scan_table_all(spark, "t_scan_all").count() == 3


def test_every_row_of_a_file_is_in_the_table_or_among_the_rejects(spark):
    r = rides(spark, SF001)
    good = r.select([F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in RIDES_COLUMNS]).limit(4).collect()
    at = {c: RIDES_COLUMNS.index(c) for c in RIDES_COLUMNS}
    lines = [",".join(RIDES_COLUMNS)]
    for k, row in enumerate(good):
        row = list(row)
        row[0] = f"ok{k}"
        row[at["price"]] = ['"£1,234.50"', "0.5", "1234567.10", '" £12 "'][k]
        lines.append(",".join(row))
    base = list(good[0])
    faults = {"price": ["1e3", '"1,23"', "12.345", "£", "n/a", "--5"], "date_of_journey": ["2024-13-45", "2023-02-29", "01/02/2024", "soon"]}
    for c, texts in faults.items():
        for t in texts:
            row = list(base)
            row[0], row[at[c]] = f"bad {c}", t
            lines.append(",".join(row))
    lines += ["short,2024-01-01", ",".join(base) + ",one more", ",".join(["nulls"] + ["None"] * 17), ",".join(["blank"] + [""] * 17)]
    path = _dir(spark)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    table, rejects = files.scan_rides_checked(spark, path)
    kept = {x.transaction_id: x for x in table.collect()}
    assert set(kept) == {"ok0", "ok1", "ok2", "ok3", "nulls", "blank"} and table.dtypes == files.scan_rides_csv(spark, path).dtypes
    assert [str(kept[f"ok{k}"].price) for k in range(4)] == ["1234.50", "0.50", "1234567.10", "12.00"]
    assert kept["nulls"].price is None and kept["blank"].date_of_journey is None
    out = [(x.transaction_id, tuple(x.reasons)) for x in rejects.collect()]
    assert sorted(x for x in out if x[0].startswith("bad")) == sorted((f"bad {c}", (c,)) for c, ts in faults.items() for _ in ts)
    cut = [x for x in rejects.collect() if x.reasons[0] == files.MALFORMED]
    assert len(cut) == 2 and any(x.record == "short,2024-01-01" for x in cut)
    assert len(kept) + len(out) == len(lines) - 1
    from ticketlens.sources.publish import published
    folder = _dir(spark)
    files.ingest_rides(spark, path, folder)
    t = published(spark, folder)
    assert {x.outcome: x.n for x in t["counts"].collect()} == {"accepted": 6, "rejected": 12, "price": 6, "date_of_journey": 4, "malformed": 2}
    assert t["rides"].count() == 6 and t["rejects"].count() == 12
