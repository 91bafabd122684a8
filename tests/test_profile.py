import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ticketlens.operators import profile


@pytest.fixture(scope="module")
def numbers(spark):
    rnd = np.random.default_rng(3)
    vals = [float(x) for x in rnd.integers(0, 500, 2001) / 4.0]
    pdf = pd.DataFrame({"a": vals, "b": [v * 3 for v in vals]})
    df = spark.createDataFrame(pdf).select(F.col("a").cast("decimal(18,2)").alias("a"),
                                           F.col("b").cast("decimal(18,2)").alias("b"))
    return pdf, df.repartition(7)


def test_numeric_profile_matches_pandas(numbers):
    pdf, df = numbers
    got = {r.column_name: r.asDict() for r in profile.numeric_profile(df, ["a", "b"]).collect()}
    for c in ("a", "b"):
        s = pdf[c]
        g = got[c]
        assert g["count"] == len(s)
        assert g["median"] == pytest.approx(s.median(), abs=0.006)
        for q, k in ((0.25, "q1"), (0.5, "q2"), (0.75, "q3")):
            assert g[k] == pytest.approx(s.quantile(q), abs=0.006)
        assert g["std"] == pytest.approx(s.std(), abs=0.006)
        assert g["mode"] == min(s.mode())
        assert g["min"] == s.min() and g["max"] == s.max()


def test_quantiles_exact_on_small_input(spark):
    df = spark.createDataFrame([(x,) for x in (1, 2, 3, 4)], "x int")
    d = profile.describe(df, ["x"]).first()
    assert (d.p25, d.p50, d.p75) == (1.75, 2.5, 3.25)  # linear, not approximate


def test_all_modes_and_skip_quartiles(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (2,), (3,), (None,)], "day int")
    modes = [r.mode for r in profile.all_modes(df, ["day"]).collect()]
    assert modes == [1.0, 2.0]
    p = profile.numeric_profile(df, ["day"], skip_quartiles_for=["day"]).first()
    assert p.q1 is None and p.iqr is None and p["count"] == 6 and p.mode == 1.0


def test_null_counts_and_schema(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    n = {r.column_name: (r.null_count, r.null_pct) for r in profile.null_counts(df, True).collect()}
    assert n["a"][0] == 1 and n["b"][0] == 2 and n["b"][1] == pytest.approx(200 / 3)
    s = profile.schema_profile(df).collect()
    assert [(r.column_name, r.data_type, r.non_null_count, r.row_count, r.column_count) for r in s] == \
        [("a", "int", 2, 3, 2), ("b", "string", 1, 3, 2)]


def test_categorical_profile_ties_pick_lowest_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "k string")
    r = profile.categorical_profile(df, ["k"]).collect()
    assert {x.value: x["count"] for x in r} == {"a": 2, "b": 2, "c": 1}
    assert {(x.total_count, x.unique_values, x.most_common, x.most_common_count) for x in r} == \
        {(6, 3, "a", 2)}


def test_row_at_position_and_head(spark):
    df = spark.createDataFrame([(i, f"r{i}") for i in range(1000)], "k int, v string").repartition(5)
    got = [(r.position, r.k) for r in profile.row_at_position(df, ["k"], [0, 1, 777]).collect()]
    assert got == [(0, 0), (1, 1), (777, 777)]
    assert [r.k for r in profile.head_n(df, ["k"], 3).collect()] == [0, 1, 2]


def test_same_plan_for_any_position(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")

    def shape(position):
        plan = profile.row_at_position(df, ["k"], [position])._jdf.queryExecution().optimizedPlan()
        return [line.strip(" :+-").split(" ")[0] for line in plan.toString().split("\n")]

    assert shape(0) == shape(10**6)


def test_nearly_equal_doubles_are_different_values(spark):
    df = spark.createDataFrame([(1.00000012,), (1.00000034,), (2.0,), (2.0,)], "x double")
    assert [(r.mode, r.mode_count) for r in profile.all_modes(df, ["x"]).collect()] == [(2.0, 2)]
    one = spark.createDataFrame([(1.00000012,), (1.00000034,), (2.0,)], "x double")
    assert profile.all_modes(one, ["x"]).count() == 3  # all tie, none merged


def test_unrounded_describe_of_mixed_types(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.25), (4, None)], "i int, x double")
    d = {r.column_name: r for r in profile.describe(df, ["i", "x"], digits=None).collect()}
    assert d["x"].mean == 0.375 and d["x"]["count"] == 2 and d["x"].p50 == 0.375
    assert d["i"].mean == 7 / 3 and d["i"].std == pytest.approx(1.5275252316519468)


def test_column_without_values_is_kept(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (None, "b")], "x string, y string")
    out = {r.column_name: (r.unique_values, r.most_common, r.most_common_count)
           for r in profile.distinct_count_per_column(df, ["x", "y"]).collect()}
    assert out == {"x": (0, None, None), "y": (2, "b", 2)}


def _sorting_aggregates(df):
    """Aggregates that sort their input: those of Spark's SortAggregate that have grouping keys (one without
    keys reads its rows as they come)."""
    return re.findall(r"SortAggregate\(key=\[[^\]]", df._jdf.queryExecution().executedPlan().toString())


def test_summaries_scan_once_and_hash(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "x string, y int")
    for out in (profile.distinct_count_per_column(df, ["x"]), profile.numeric_profile(df, ["y"])):
        assert not _sorting_aggregates(out)


def _summaries(values):
    """(unique values, lowest most common value, its count) by plain Python."""
    c = Counter(str(v) for v in values if v is not None)
    top = max(c.values(), default=None)
    return len(c), min((v for v, n in c.items() if n == top), default=None), top


def test_heavy_hitters_are_exact_whatever_the_summary_holds(spark):
    rnd = random.Random(5)
    n = 4000
    columns = {
        "unique": [f"id{i:05d}" for i in range(n)],  # every value once: counted whole
        "ties": [f"t{i % 500:03d}" for i in range(n)],  # all values tied, more than the summary keeps
        "few": [rnd.choice("abc") for _ in range(n)],
        "skewed": ["hot" if i % 3 else f"s{i}" for i in range(n)],  # two thirds are one value
        "hidden": ["x" if i % 40 == 0 else f"h{i}" for i in range(n)],  # the best one is below what is left
        "nothing": [None] * n,
        "holes": [None if i % 2 else rnd.choice(["p", "q"]) for i in range(n)],
    }
    rows = list(zip(*columns.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).repartition(5)
    want = {c: _summaries(v) for c, v in columns.items()}
    freq, summary = profile.categorical_summary(df, list(columns), keep=8, tracked=32)
    got = {r.column_name: (r.unique_values, r.most_common, r.most_common_count) for r in summary.collect()}
    assert got == want and all(r.total_count == n for r in summary.collect())
    counts = {(r.column_name, r.value): r.cnt for r in freq.collect()}
    assert counts == {(c, v): k for c, vs in columns.items() for v, k in Counter(x for x in vs if x is not None).items()}
    common = {r.column_name: (r.most_common, r.most_common_count)
              for r in profile.most_common_values(df, list(columns), keep=8, tracked=32).collect()}
    assert common == {c: w[1:] for c, w in want.items()}


def test_settled_columns_are_not_counted_value_by_value(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 3).cast("string").alias("k"))
    heavy = profile.heavy_hitters(df, ["id", "k"])
    held = {r.column_name: r.n for r in profile.recount(df, heavy, ["id", "k"]).groupBy("column_name").agg(F.sum("cnt").alias("n")).collect()}
    assert held["k"] == 3000 and held.get("id", 0) < 3000
    assert not _sorting_aggregates(profile.distinct_count_per_column(df, ["id", "k"]))


def test_position_index_holds_keys_only(spark):
    rows = [(None if i == 3 else i % 40, i, f"payload {i}") for i in range(900)]
    df = spark.createDataFrame(rows, "a int, b long, c string").repartition(6)
    index = profile.position_index(df, ["a", "b"])
    assert sorted(index.columns) == ["_pid", "_place", "a", "b"] and index.count() == 900
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = {r.position: (r.a, r.b) for r in profile.keys_at(index, [0, 450, 899, 900, 10**9]).collect()}
    assert got == {p: order[p][:2] for p in (0, 450, 899)}
    out = profile.row_at_position(df, ["a", "b"], [899, 0, 777])
    assert [(r.position, r.a, r.b, r.c) for r in out.collect()] == [(p, *order[p]) for p in (0, 777, 899)]
    assert profile.row_at_position(df.limit(0), ["a", "b"], [0]).count() == 0


def test_bracketed_quantiles_equal_sorted_ones(spark):
    rnd = random.Random(11)
    columns = {
        "spread": [rnd.gauss(0, 1000) for _ in range(5000)],
        "hot": [7.0 if rnd.random() < 0.6 else rnd.uniform(0, 20) for _ in range(5000)],  # all quartiles in one value's run
        "steps": [float(rnd.randrange(3)) for _ in range(5000)],
        "holes": [None if rnd.random() < 0.7 else rnd.expovariate(1) for _ in range(5000)],
        "none": [None] * 5000,
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(7)
    df = df.withColumn("money", (F.col("spread") * 100).cast("decimal(18,2)"))
    cols = [*columns, "money"]
    freq = profile.materialise(profile.frequency_table(df, cols), "f")
    want = {(c, p): np.quantile([v for v in vs if v is not None], p) for c, vs in columns.items() if c != "none" for p in profile.QUARTILES}
    money = [float(r.money) for r in df.select("money").collect()]
    want |= {("money", p): np.quantile(money, p) for p in profile.QUARTILES}
    honest = profile.quantile_brackets(df, cols)
    wrong = honest.withColumn("lo", F.col("lo") + 10_000).withColumn("hi", F.col("hi") + 10_000)  # holds no rank: opened
    for brackets in (honest, wrong, honest.withColumn("lo", F.lit(None).cast("double"))):
        got = {(r.column_name, float(r.p)): r.quantile for r in profile.exact_quantiles(freq, brackets).collect()}
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 * max(1, abs(want[k])) for k in want)
    b = honest.where("column_name = 'spread' and p = 0.5").first()
    assert 0 < df.where(F.col("spread").between(b.lo, b.hi)).count() < 200  # of 5000
