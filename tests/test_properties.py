"""Properties and metamorphic checks: results do not depend on how the input is partitioned."""

from decimal import Decimal

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketlens.operators import profile
from ticketlens.operators.aggregate import value_counts, with_share
from ticketlens.operators.ids import with_contiguous_id

ROWS = st.lists(st.tuples(st.sampled_from(["Advance", "Anytime", "Off-Peak", None]),
                          st.integers(min_value=0, max_value=50_000)), min_size=1, max_size=300)


def _frame(spark, rows, parts):
    df = spark.createDataFrame([(k, Decimal(p) / 100) for k, p in rows], "k string, price decimal(18,2)")
    return df.repartition(parts)


@settings(max_examples=4, deadline=None)
@given(rows=ROWS, parts=st.integers(min_value=1, max_value=9))
def test_value_counts_and_shares_match_pandas(spark, rows, parts):
    df = _frame(spark, rows, parts)
    got = {r.k: (r["count"], r.share_pct) for r in with_share(value_counts(df, "k"), "count").collect()}
    s = pd.Series([k for k, _ in rows]).value_counts(dropna=True)
    assert {k: c for k, (c, _) in got.items()} == s.to_dict()
    if len(s):
        assert abs(sum(p for _, p in got.values()) - 100.0) < 1e-9


@settings(max_examples=4, deadline=None)
@given(rows=ROWS, parts=st.integers(min_value=1, max_value=9))
def test_numeric_profile_is_partitioning_invariant(spark, rows, parts):
    a = profile.numeric_profile(_frame(spark, rows, 1), ["price"]).collect()
    b = profile.numeric_profile(_frame(spark, rows, parts), ["price"]).collect()
    assert a == b


@settings(max_examples=3, deadline=None)
@given(n=st.integers(min_value=1, max_value=400), parts=st.integers(min_value=1, max_value=9))
def test_contiguous_ids_are_a_permutation_in_key_order(spark, n, parts):
    df = spark.range(n).select(((F.col("id") * 37) % 11).alias("g"), F.col("id").alias("u"))
    ided = with_contiguous_id(df.repartition(parts), ["g", "u"], "rid").collect()
    assert sorted(r.rid for r in ided) == list(range(1, n + 1))
    by_id = [(r.g, r.u) for r in sorted(ided, key=lambda r: r.rid)]
    assert by_id == sorted(by_id)
