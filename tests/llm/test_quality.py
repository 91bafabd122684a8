import numpy as np
import pyarrow as pa
import pytest

from ticketlens.llm import quality_gam as q
from ticketlens.llm.queries import QUERIES
from tests.llm.conftest import PROSE


def test_features_of_whole_texts():
    junk = "Ha Ha Ha of of of\nHa Ha Ha of of of\nWOW!! $$$"
    x = dict(zip(q.FEATURES, q.features(pa.array([junk, None, ""]))[0]))
    assert x["log_words"] == pytest.approx(np.log1p(14))
    assert x["distinct_words"] == pytest.approx(4 / 14)
    assert x["next_repeat"] == pytest.approx(8 / 14)
    assert x["line_repeat"] == pytest.approx(1 / 3)
    assert not q.features(pa.array([None, ""])).any()


def test_tables_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    p = q.fit(x[:3000], y[:3000]).score(x[3000:])
    assert ((p > 0.5) == y[3000:]).mean() > 0.9  # no sum of single-feature tables can do this
    assert ((p >= 0) & (p <= 1)).all()


def test_held_out_accuracy_on_the_given_labels(spark):
    import pandas as pd
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op1_quality_gam"](spark, sf).toPandas()
    assert len(got) == 1000 and set(got.columns) == {"doc_id", "held_out", "score", "predicted"}
    held = got[got.held_out].merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    assert len(held) > 40 and ((held.score >= 0.3) == (held.quality == 1)).mean() > 0.93
    again = QUERIES["op1_quality_gam"](spark, sf).toPandas()
    assert got.sort_values("doc_id").score.tolist() == again.sort_values("doc_id").score.tolist()


def test_odd_input(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (None, 1), (5, None), (99, 1)], "doc_id long, quality int")
    model = q.train(odd_docs, labels)
    out = q.score(odd_docs, model)
    assert [c.lower() for c in out.columns].count("score") == 1 and out.count() == 10
    assert all(0 <= r.score <= 1 for r in out.collect())
    kept = q.keep_good(odd_docs, model, least=0.0)
    assert kept.columns == odd_docs.columns and kept.count() == 10
    flat = q.train(no_docs, labels)  # no labelled document: the smoothed share
    assert {r.score for r in q.score(odd_docs, flat).collect()} == {0.5}
    assert q.score(no_docs, model).count() == 0
    none = labels.where("quality > 5")
    assert q.train(odd_docs, none).intercept == 0.0


def test_labels_above_the_bound_are_thinned(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", f"concat('{PROSE}', id) AS text")
    labels = spark.range(3000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    assert q.train(docs, labels, max_train=200).tables
